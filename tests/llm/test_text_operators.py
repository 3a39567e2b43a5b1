"""The operators on texts, against plain versions on small tables."""

import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ticketlens.llm import quality, queries, sentencepiece_fst, simhash, substring_dedup, token_records, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(words):
    shared, common = words(40), words(15)
    out = [(i, f"{words(30)} {shared if i % 4 == 0 else ''} {words(9)}\n{common if i % 3 == 0 else words(12)}") for i in range(20)]
    out += [(20, out[3][1]), (21, out[3][1]), (21, out[3][1]), (22, None), (23, ""), (24, " \t\n"), (25, "one"), (None, out[8][1]), (26, "é  x y " + words(20)), (27, "la " * 3000)]
    return out + [(28, words(20_000, 5000)), (29, "x" * 70_000)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def removed_by_hand(texts, width=13):
    key = lambda i: 2**63 - 1 if i is None else i
    first = {}
    cut = [(i, WORD.findall(t or "")) for i, t in texts]
    for i, ws in cut:
        for k in range(len(ws) - width + 1):
            g = tuple(ws[k : k + width])
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, ws in cut:
        gone = {j for k in range(len(ws) - width + 1) if first[tuple(ws[k : k + width])] < key(i) for j in range(k, k + width)}
        out.append((i, len(ws), len(gone), " ".join(w for j, w in enumerate(ws) if j not in gone)))
    return sorted(out, key=repr)


def test_substrings(make, texts):
    got = substring_dedup.dedup_substrings(make(texts)).select("doc_id", "n_words", "n_removed", "kept")
    assert rows(got) == removed_by_hand(texts)
    assert substring_dedup.dedup_substrings(make([])).count() == 0


def test_window_hashes_roll():
    w = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    assert (substring_dedup.window_hashes(np.concatenate([w, w]), 13)[:38] == substring_dedup.window_hashes(w, 13)).all()
    assert len(set(substring_dedup.window_hashes(w, 13).tolist())) == 38


def test_removal_intervals_are_maximal(make, words):
    passage = words(30)
    got = substring_dedup.dedup_substrings(make([(1, f"{passage} a b"), (2, f"x {passage} y {passage}")])).where("doc_id = 2").first()
    assert [tuple(s) for s in got["removed"]] == [(1, 31), (32, 62)] and got["kept"] == "x y"


def test_sentencepiece_equals_the_library(make, texts):
    import sentencepiece as spm

    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = spm.SentencePieceProcessor(model_file=path)
    more = [(100, "a ▁b  ▁"), (101, "日本語 😀\x00"), (102, "   "), (103, "<s> </s> <0x41>")]
    got = sentencepiece_fst.encode_decode(make(texts + more), path)
    want = [(i, len(ids := sp.encode(t or "")), ids, sp.decode(ids), sp.decode(ids) == (t or "")) for i, t in texts + more]
    assert rows(got) == sorted(want, key=repr)
    assert sentencepiece_fst.encode_decode(make([]), path).count() == 0


def test_sentencepiece_on_random_strings():
    import sentencepiece as spm

    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp, rng = spm.SentencePieceProcessor(model_file=path), random.Random(8)
    with open(path, "rb") as f:
        machine = sentencepiece_fst.Transducer(f.read())
    for _ in range(4000):
        t = "".join(rng.choice("abcdeishtonr .,é1\n") for _ in range(rng.randint(0, 30)))
        assert machine.encode(t).tolist() == sp.encode(t)


def test_unigram_path_is_the_best_one():
    pieces = {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -1.5, "▁": -1.0, "▁a": -1.2}
    machine = object.__new__(sentencepiece_fst.Transducer)
    machine.kind, machine.longest, machine.floor, machine.bytes_, machine.unknown = 1, 2, -12.0, {}, 99
    names = list(pieces)
    machine.pieces, machine.arcs = [(p, s, 1) for p, s in pieces.items()], {p: i for i, p in enumerate(names)}

    def best(s):
        if not s:
            return 0.0
        return max(score + best(s[len(p):]) for p, score in pieces.items() if s.startswith(p))

    for s in ("abab", "▁abba", "bbaab"):
        ids = machine.shortest_path(s)
        assert "".join(names[i] for i in ids) == s and sum(pieces[names[i]] for i in ids) == pytest.approx(best(s))


def simhash_by_hand(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_by_hand(docs):
    fps = [simhash_by_hand(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, f"{fps[i]:016x}", min(least[find(i)], default=None)) for i, (d, _) in enumerate(docs)), key=repr)


def test_simhash(make, texts, words):
    near = words(300).split()
    docs = texts + [(200 + i, " ".join([*near[:i], "changed", *near[i + 1 :]])) for i in range(12)] + [(300, "One TWO"), (301, "one two")]
    import pyspark.sql.functions as F

    got = simhash.near_duplicates(make(docs)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    want = components_by_hand(docs)
    assert rows(got) == want
    assert len({c for d, _, c in want if d and d >= 200 and d < 212}) < 12  # links were there to be found
    assert simhash.near_duplicates(make([])).count() == 0
    kept = simhash.keep_one(make(docs))
    assert kept.columns == make([]).columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted({c for _, _, c in rows(got)}, key=repr)


def test_simhash_survivors(spark, words):
    """One row of each group stays, whatever the order of the rows, and other columns keep their values."""
    a, b = words(60), words(60)
    docs = [(0, a, "x", 1), (1, a, "x", 2), (1, b, "x", 3), (1, b, "y", 3), (1, b, "y", 3), (None, a, None, 0), (None, "", None, 0), (None, None, "z", 0)]
    schema = "doc_id long, text string, __row string, fp int"
    found = [sorted((tuple(r) for r in simhash.keep_one(spark.createDataFrame(d, schema)).collect()), key=repr) for d in (docs, docs[::-1], docs[3:] + docs[:3])]
    assert found[0] == found[1] == found[2]
    assert [r[:2] for r in found[0] if r[0] is not None] == [(0, a), (1, b)] and len(found[0]) == 3
    assert simhash.keep_one(spark.createDataFrame([], schema)).count() == 0


def test_simhash_links_across_chunks(spark):
    """Chained fingerprints in one hot key, cut into many chunks, stay one component each."""
    rng = np.random.default_rng(4)
    fps = []
    for _ in range(3):
        x = int(rng.integers(0, 2**62))
        for step in range(60):
            fps.append(x)
            x ^= 1 << (step % 20)
            x ^= 1 << ((step * 7) % 20)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, chunk=16)).collect()}
    groups = defaultdict(set)
    for f in fps:
        groups[found.get(f, f)].add(f)
    seen, want = set(), []
    for f in fps:
        if f not in seen:
            todo, comp = [f], set()
            while todo:
                y = todo.pop()
                if y not in comp:
                    comp.add(y)
                    todo += [z for z in fps if (y ^ z).bit_count() <= 4]
            seen |= comp
            want.append(comp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 6, dtype=np.uint64)
    fps = np.unique(np.array([int(b) ^ sum(1 << k for k in set(rng.integers(0, 64, rng.integers(0, 9)).tolist())) for b in base for _ in range(40)], np.uint64))
    group = np.zeros(len(fps), np.int64)

    def closure(links):
        root = {int(f): int(f) for f in fps.view(np.int64)}
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in links:
            root[find(a)] = find(b)
        return {frozenset(f for f in root if find(f) == r) for r in map(find, root)}

    signed = fps.view(np.int64).tolist()
    exact = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    assert closure(simhash.close_rows(fps, group, radius)) == closure(exact)
    left, right = fps[::3], np.concatenate([fps[1::3], fps[2::3]])
    across = simhash.close_between(left, right, radius) + simhash.close_between(right, left, radius)
    want = [(a, b) for a in left.view(np.int64).tolist() for b in right.view(np.int64).tolist() if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    assert closure(across) == closure(want)


def quality_by_hand(text):
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_rules(make, texts, words, spark):
    some = words(60, 30)
    docs = texts + [(400, f"{some}\n{some}\n{some} a#b"), (401, f"{words(200, 4)}"), (402, "a b c a b c " + words(200, 10_000)), (403, "l1 x\nl1 x\n\n \n\n" + words(70))]
    got = quality.judge(make(docs), spark.createDataFrame([], "doc_id long"))
    found = sorted((tuple([r["doc_id"], *list(r["quality"])[:6]]) for r in got.collect()), key=repr)
    assert found == sorted(((i, *quality_by_hand(t)) for i, t in docs), key=repr)
    assert all(r["quality"]["kept"] != r["quality"]["base_failed"] for r in got.collect())  # nothing to compare with
    assert quality.keep(make([]), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_quality_score_is_the_mean_log_ratio(make, words, spark):
    import math

    docs = [(i, words(80, 300) if i < 30 else " ".join(f"junk{j}###" for j in range(80))) for i in range(40)]
    trusted = spark.createDataFrame([(i,) for i in [*range(20), None, 3]], "doc_id long")
    weights = quality.log_ratios(make(docs), trusted)
    cells = make(docs).selectExpr("doc_id", "transform(split(text, ' '), x -> xxhash64(x)) as h").select("doc_id", quality._cells("h").alias("c"), quality.fold_of(F.col("doc_id")).alias("f")).collect()
    corpus, target = Counter(), [Counter() for _ in range(quality.FOLDS)]
    for r in cells:
        corpus.update(r["c"])
        if r["doc_id"] < 20:
            target[1 - r["f"]].update(r["c"])  # a document is scored by the other half
    share = lambda c, cell: math.log((c[cell] + 1) / (c.total() + quality.CELLS))
    seen = {(f, k) for f, t in enumerate(target) for k in [*t, *corpus, 0, 77]}
    assert len(weights) == quality.FOLDS * quality.CELLS
    for f, k in seen:
        assert weights[f * quality.CELLS + k] == round(quality.GRAIN * (share(target[f], k) - share(corpus, k)))
    got = {r["doc_id"]: r["quality"] for r in quality.judge(make(docs), trusted).collect()}
    for r in cells:
        assert got[r["doc_id"]]["score"] == pytest.approx(sum(weights[r["f"] * quality.CELLS + c] for c in r["c"]) / len(r["c"]) / quality.GRAIN)
    kept = {d for d, q in got.items() if q["kept"]}
    assert kept >= set(range(20)) and not kept & set(range(30, 40))
    assert {r["doc_id"] for r in quality.keep(make(docs), trusted).collect()} == kept


def test_quality_rows_of_ids(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("if(id % 100 = 99, null, id) as k", "id as v")
    ids = spark.range(0, 5000, 7).selectExpr("id as __t")
    want = [i for i in range(3000) if i % 7 == 0 and i % 100 != 99]
    for bits in (quality.ID_BITS, 1 << 15, 64):  # a crowded bitmap only lets more rows through to the join
        monkeypatch.setattr(quality, "ID_BITS", bits)
        assert sorted(r["v"] for r in quality.rows_of(rows, ids, "k").collect()) == want
    assert quality.rows_of(rows, ids.limit(0), "k").count() == 0


def test_quality_keeps_columns_whose_names_it_uses(spark, words):
    names = ["n", "h", "two", "base", "w", "l", "g", "r", "given", "id", "fold", "score", "__w", "__n", "__row", "__bits", "__t", "__id", "__text", "__verdict", "quality"]
    docs = spark.createDataFrame([(i, words(60), *[f"{c}{i}" for c in names]) for i in range(9)] + [(9, None, *names), (None, "", *names)], ["doc_id", "text", *names])
    trusted = spark.createDataFrame([(i,) for i in range(5)], "doc_id long")
    got = quality.judge(docs, trusted, to="verdict")
    assert got.columns == [*docs.columns, "verdict"] and sorted(map(repr, got.drop("verdict").collect())) == sorted(map(repr, docs.collect()))
    kept = quality.keep(docs, trusted)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in got.where("verdict.kept").select(*docs.columns).collect())
    assert quality.judge(docs, trusted, to="verdict", columns=["doc_id"]).columns == ["doc_id", "verdict"]


def test_quality_target_is_counted_on_every_trusted_row(spark):
    n = 20_600
    docs = spark.range(n).selectExpr("id as doc_id", "concat('u', id % 7) as text")
    weights = quality.log_ratios(docs, docs.select("doc_id"))
    # the target is the corpus: both halves have about its shares (0.5 nats are log(1 + CELLS / n) for the unseen cells)
    seen = [c for r in docs.limit(7).selectExpr("array(xxhash64(text)) as h").select(quality._cells("h").alias("c")).collect() for c in r["c"]]
    for fold in range(quality.FOLDS):
        of = [weights[fold * quality.CELLS + c] / quality.GRAIN for c in seen]
        assert max(of) - min(of) < 0.2


def test_quality_threshold_follows_the_labels(make, words, spark):
    assert quality.between({5: 3, 9: 1}, {-7: 2, 1: 4}) == 3 / quality.GRAIN  # the middle of the gap
    assert quality.between({0: 1, 10: 99}, {1: 99, -9: 1}) == 5.5 / quality.GRAIN  # one good row is lost
    assert quality.between({4: 1, 6: 1}, {}) == 4 / quality.GRAIN and quality.between({}, {}) is None
    shared = [words(100, 300) for _ in range(80)]  # the low class differs in a few words only
    docs = [(i, t if i < 40 else t + " junk" * 2 + " spam of a kind" * 3) for i, t in enumerate(shared)]
    ids = lambda a, b: spark.createDataFrame([(i,) for i in range(a, b)], "doc_id long")
    got = {r["doc_id"]: r["quality"] for r in quality.judge(make(docs), ids(0, 40), rejected=ids(40, 80)).collect()}
    good, low = (sorted(got[i]["score"] for i in rows) for rows in (range(40), range(40, 80)))
    at = [sum(x < c for x in good) + sum(x >= c for x in low) for c in good + low]
    wrong = sum(got[i]["kept"] != (i < 40) for i in range(80))
    assert wrong <= min(at) and wrong <= 8  # no cut has fewer errors


def test_token_records_round_trip(make, texts, spark, tmp_path):
    import tokenizers

    path = queries.tokenizer_path("word_bpe_49k.json")
    full = tokenizers.Tokenizer.from_file(path)
    docs = texts + [(500, "It's <|endoftext|> A<|STARTOFTEXT|>b éÉ ÀÖß ﬁne 12.5%% x"), (501, "Hello, WORLD!! naïve—dash")]
    folder = f"file://{tmp_path}/records"
    manifest = token_records.write_records(make(docs), folder, path)
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u2").tolist()) for r in token_records.read_records(spark, folder, manifest).collect()]
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    want, at = [], 0
    for i, t in order:
        ids = [*full.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, ids))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    sums = {(r["start"], r["ids_crc32"]) for r in token_records.digests(spark, folder, manifest).collect()}
    assert sums == {(s, zlib.crc32(np.array(ids, "<u4").tobytes())) for _, s, ids in want}
    empty = token_records.write_records(make([]), f"file://{tmp_path}/none", path)
    assert token_records.read_records(spark, f"file://{tmp_path}/none", empty).count() == 0


def test_token_records_of_a_large_vocabulary(make, spark, tmp_path):
    """Ids beyond two bytes: the manifest has the width that the files are written with."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    names = [f"t{i}" for i in range(70_000)]
    made = Tokenizer(models.WordLevel({w: i for i, w in enumerate(names)}, unk_token="t0"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(str(tmp_path / "large.json"))
    docs = make([(1, "t69999 t5 t65536"), (2, None), (3, "t2 t66000")])
    folder = f"file://{tmp_path}/large"
    manifest = token_records.write_records(docs, folder, str(tmp_path / "large.json"))
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], f"<u{r['width']}").tolist()) for r in token_records.read_records(spark, folder, manifest).collect())
    assert got == [(1, 0, 4, [69999, 5, 65536, 1]), (2, 4, 1, [1]), (3, 5, 3, [2, 66000, 1])]
    sums = {r["doc_id"]: r["ids_crc32"] for r in token_records.digests(spark, folder, manifest).collect()}
    assert sums[1] == zlib.crc32(np.array([69999, 5, 65536, 1], "<u4").tobytes())


def test_decomposed_capitals_get_the_tokenizers_ids():
    import tokenizers

    path = queries.tokenizer_path("word_bpe_49k.json")
    full, encoder = tokenizers.Tokenizer.from_file(path), token_records.WordEncoder(path)
    texts = ["J\u030c", "T\u0308 Plain Words", "see H\u0331 and W\u030a", "E\u0301COLE", "ÀÖ J\u030cK", "PLAIN Ascii"]
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts, 1)]
    assert got == [[*full.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_record_framing():
    assert token_records.crc32c_many([b"123456789"])[0] == 0xE3069283
    rng = random.Random(2)
    payloads = [rng.randbytes(n) for n in (0, 1, 3, 4, 8, 511, 512, 513, 3000)]
    records = token_records.frame(payloads)
    ends = np.cumsum([len(r) for r in records]).tolist()
    blob, starts, sizes = b"".join(records), [0, *ends[:-1]], [len(p) for p in payloads]
    assert token_records.unframe(blob, starts, sizes) == payloads
    broken = bytearray(blob)
    broken[ends[-1] - 100] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(bytes(broken), starts, sizes)


def test_toxicity_held_out(make, words, spark):
    rng = random.Random(6)
    bad = ["idiot", "moron", "scum"]
    docs, labels = [], []
    for i in range(2000):
        ws, y = words(60).split(), int(i % 5 == 0)
        if y:
            ws[rng.randrange(60)] = rng.choice(bad).capitalize() + rng.choice([",", "", "!"])
        docs.append((i, " ".join(ws)))
        labels.append((i, y if i % 7 else None))
    docs += [(3000, None), (3001, ""), (None, "idiot"), (3, docs[3][1])]
    got = toxicity.score(make(docs), spark.createDataFrame([*labels, (None, 1)], "doc_id long, label int")).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    unseen = [(r["score"] >= 0.5, r["doc_id"] % 5 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 2000 and r["doc_id"] % 7 == 0]
    assert sum(a == b for a, b in unseen) >= 0.95 * len(unseen)
    assert toxicity.score(make([]), spark.createDataFrame([], "doc_id long, label int")).count() == 0
    none = toxicity.score(make(docs[:3]), spark.createDataFrame([], "doc_id long, label int")).collect()
    assert [r["score"] for r in none] == [0.5] * 3


def test_ftrl_is_sparse():
    rng = np.random.default_rng(1)
    sets = [np.unique(np.append(rng.integers(100, 5000, 40), np.full(i % 2, 7))) for i in range(300)]
    cells, weights, _ = toxicity.Ftrl().fit(sets, np.arange(300) % 2)
    assert len(cells) < 200 and weights[cells == 7][0] == weights.max()


def test_toxicity_features_one_by_one():
    def plain(text):
        mask = (1 << 64) - 1
        cores = [w.strip(string.punctuation).lower() for w in text.split()]
        h = [xxhash.xxh64_intdigest(c.encode()) | 1 for c in cores if c]
        grams = list(h)
        for gap, mark in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            grams += [((a * mark) & mask) ^ ((b + (mark >> 7)) & mask) for a, b in zip(h, h[gap:], strict=False)]
        return {(((g ^ (g >> 29)) * 0xBF58476D1CE4E5B9) & mask) >> 42 for g in grams}

    given = ["You are, an IDIOT!", "", "one", "a a a a", "... !!! x", "Größe (über) alles"]
    cells, docs = toxicity._grams(given)
    assert [set(cells[docs == k].tolist()) for k in range(len(given))] == [plain(t) for t in given]


def test_ftrl_equals_the_plain_one():
    """The textbook update, a dictionary entry a coordinate."""
    rng = np.random.default_rng(2)
    sets = [np.unique(np.append(rng.integers(100, 400, 12), np.full(i % 2, 7))) for i in range(120)]
    labels = np.arange(120) % 2
    ftrl = toxicity.Ftrl(l1=0.5, passes=2)
    cells, weights, bias = ftrl.fit(sets, labels)
    z, n, b, bn = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(c):
        if abs(z[c]) <= ftrl.l1:
            return 0.0
        return -math.copysign(abs(z[c]) - ftrl.l1, z[c]) / ((ftrl.beta + math.sqrt(n[c])) / ftrl.alpha + ftrl.l2)

    order = np.random.default_rng(7)
    for _ in range(2):
        for i in order.permutation(120).tolist():
            ws = {c: weight(c) for c in sets[i].tolist()}
            g = 1 / (1 + math.exp(-(b + sum(ws.values())))) - labels[i]
            for c, w in ws.items():
                sigma = (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / ftrl.alpha
                z[c], n[c] = z[c] + g - sigma * w, n[c] + g * g
            bn += g * g
            b -= 0.05 * g / math.sqrt(1 + bn)
    want = {c: w for c in z if (w := weight(c))}
    assert dict(zip(cells.tolist(), weights.tolist(), strict=True)) == pytest.approx(want, rel=1e-5) and bias == pytest.approx(b)


def test_toxicity_scores_refer_to_the_labels_own_mix(make, words, spark, monkeypatch):
    """Odd rows too: repeated and contradicting labels, equal texts, a very long text."""
    rng = random.Random(8)
    docs = [(i, words(30, 60) + (" moron" if i % 10 == 0 and rng.random() < 0.7 else "")) for i in range(1500)]
    docs += [(2000, words(100_000)), (2001, docs[0][1]), (2001, docs[0][1]), (2002, "")]
    labels = [(i, int(i % 10 == 0)) for i in range(1500)] + [(0, 1), (0, 0), (2001, 1), (2000, 0), (None, 1)]
    given = spark.createDataFrame(labels, "doc_id long, label int")
    whole = {r["doc_id"]: r["score"] for r in toxicity.score(make(docs), given).collect()}
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 150)
    some = {r["doc_id"]: r["score"] for r in toxicity.score(make(docs), given).collect()}
    assert toxicity.rate_shift(151, 1352) == pytest.approx(math.log(1352 / 150))
    assert toxicity.rate_shift(0, 0) == 0 and whole[2001] == pytest.approx(whole[0])
    clean = [i for i in range(1500) if i % 10]
    for scores in (whole, some):  # as rare in the scores, whether or not the other class was drawn from
        assert np.mean([scores[i] for i in clean]) <= 0.15 and sum(scores[i] >= 0.5 for i in clean) <= 0.01 * len(clean)
        assert np.mean([scores[i] >= 0.5 for i, t in docs[:1500] if t.endswith("moron")]) >= 0.95
    *_, bias = toxicity.fit(toxicity.sample(make(docs), given, "doc_id", "text"))
    assert some[2002] == pytest.approx(1 / (1 + math.exp(math.log(1352 / 150) - bias)))
