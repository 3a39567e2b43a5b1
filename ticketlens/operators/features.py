"""N-gram TF-IDF in relational form: (id, term, weight) tables.

Plan shape (see README "Scale"):

* documents are hash-partitioned by id **before** the n-gram explode; the raw
  text is the smallest thing to move, and afterwards every per-document step
  (term counts, row norms) is satisfied by that partitioning without another
  exchange;
* document frequency is a partial + final aggregate on the term (map-side
  combine, so a hot term costs one row per task);
* the corpus size ``n`` enters as a scalar subquery, not a join;
* ``tf ⋈ idf`` is an equi-join on the term: AQE turns it into a broadcast
  join only when the measured idf side is under the broadcast threshold,
  otherwise sort-merge with skew splitting;
* row norms are a window sum by document over the joined rows, so the join is
  computed once;
* per-fold training IDF tables come from one aggregate by subtraction;
* counts of texts may travel packed (``packed_pairs``): the pairs of a text partition
  for one range of term hashes are one compressed row, a quarter of what as many
  rows take on the disks.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import MIN_TOKEN_CHARS
from ..session import scratch_path

# Vectoriser defaults.
MIN_DF = 1
MAX_DF = 0.95
NGRAM_RANGE = (1, 3)


def explode_terms(docs: DataFrame, id_col: str = "id", grams_col: str = "grams") -> DataFrame:
    """(id, term) with one row per occurrence.

    ``explode_outer`` + a null filter instead of ``explode``: for an inner
    explode Catalyst infers ``size(grams) > 0`` and pushes it under the
    repartition, which would evaluate the whole text chain twice.
    """
    src = docs.select(id_col, F.explode_outer(grams_col).alias("term"))
    return src.where(F.col("term").isNotNull())


def term_frequency(docs: DataFrame, id_col: str = "id", grams_col: str = "grams", sublinear: bool = False) -> DataFrame:
    """(id, term, tf): raw counts (or 1 + ln tf)."""
    tf = explode_terms(docs, id_col, grams_col).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    if sublinear:
        tf = tf.withColumn("tf", 1.0 + F.log(F.col("tf")))
    return tf


#: Rows that a counting task hands over at once, and characters of one id's texts that it counts at once.
ROWS = 1 << 17
CHARS = 1 << 23


def _grams(text: str, lo: int, hi: int) -> list[str]:
    words = [w for w in text.split(" ") if len(w) >= MIN_TOKEN_CHARS]
    out, longer = list(words) if lo <= 1 else [], words
    for n in range(2, hi + 1):
        longer = [f"{a} {b}" for a, b in zip(longer, words[n - 1 :])]
        if n >= lo:
            out += longer
    return out


def _texts_by_id(batches):
    """(types, id and kept values, texts) of each run of rows (text, id, kept…) with one id; its first row has the kept values."""
    types, head, texts = None, None, []
    for batch in batches:
        for text, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if head is None or values[0] != head[0]:
                if head is not None:
                    yield types, head, texts
                types, head, texts = batch.schema.types[1:], values, []
            texts.append(text or "")
    if head is not None:
        yield types, head, texts


def _counted(batches, lo: int, hi: int, outer: bool, most: int):
    """(types, heads, sizes, terms, counts): the counts of ids with ``most`` terms or more together; heads are ids and kept values."""
    heads, sizes, terms, counts, types = [], [], [], [], None
    for types, head, texts in _texts_by_id(batches):
        parts = 1 + sum(map(len, texts)) // CHARS  # an id with very much text is counted a part of its terms at a time
        for part in range(parts):
            found = Counter()
            for text in texts:
                grams = _grams(text, lo, hi)
                found.update(grams if parts == 1 else (g for g in grams if hash(g) % parts == part))
            if outer and not found and part == 0:
                found[None] = 1
            heads.append(head)
            sizes.append(len(found))
            terms.extend(found)
            counts.extend(found.values())
            if len(terms) >= most:
                yield types, heads, sizes, terms, counts
                heads, sizes, terms, counts = [], [], [], []
    if heads:
        yield types, heads, sizes, terms, counts


def _count(lo: int, hi: int, outer: bool):
    def run(batches):
        for types, heads, sizes, terms, counts in _counted(batches, lo, hi, outer, ROWS):
            at = pa.array(np.repeat(np.arange(len(heads)), sizes))
            held = [pa.array(values, kind).take(at) for values, kind in zip(zip(*heads, strict=True), types, strict=True)]
            arrays = [*held, pa.array(terms, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(f"_{n}" for n in range(len(held))), "term", "tf"])

    return run


def text_term_frequency(prepared: DataFrame, id_col: str = "id", text_col: str = "ticket_text_clean", ngram_range=NGRAM_RANGE, keep=(), outer: bool = False) -> DataFrame:
    """(id, ``keep``…, term, tf) of prepared texts, whose rows of one id lie in one partition.

    The counts of ``term_frequency`` over the n-grams of the texts' words, without an
    array of n-grams a row and a hash map over all terms of a partition: rows are
    sorted by id, and a task counts one id's texts at a time. ``outer``: an id without
    terms has one row with a null term.
    """
    fields = [T.StructField(c, prepared.schema[c].dataType) for c in (id_col, *keep)]
    schema = T.StructType([*fields, T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    rows = prepared.select(text_col, id_col, *keep).sortWithinPartitions(id_col)
    return rows.mapInArrow(_count(*ngram_range, outer), schema)


#: Pairs of a text partition that are packed at once.
PAIRS = 1 << 19
PACKED = "part int, bucket int, n int, ids binary, lengths binary, terms binary, tf binary"
WEIGHED = "part int, n int, ids binary, lengths binary, terms binary, tf binary, df binary, feature binary"
#: The part of packed rows that are no pairs but a vocabulary's, with feature ids as ids.
VOCABULARY = -1


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed numbers, their first bytes together, then their second ones: mostly equal."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _loosened(data: bytes, n: int, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(pa.decompress(data, n * kind.itemsize, codec="zstd"), np.uint8).reshape(kind.itemsize, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _id_bytes(ids: pa.Array) -> np.ndarray:
    """Longs and a byte that tells nulls, as nine bytes each."""
    out = np.empty(len(ids), _ID)
    out["value"], out["null"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
    return out


def _terms(lengths: list[np.ndarray], texts: list[bytes]) -> pa.Array:
    """The strings of several rows; more than 2 GB of them are not one bucket's."""
    ends = np.concatenate([[0], *lengths]).cumsum()
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(texts)))


def _packed(part: int, ids: np.ndarray, terms: list[str], counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (pd.util.hash_array(np.array(terms, object), categorize=False) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")  # a document's terms, which share words, stay together
    held, ids, counts = pa.array(terms, pa.large_string()).take(pa.array(order)), ids[order], counts[order]
    ends = np.frombuffer(held.buffers()[1], np.int64)[: len(held) + 1]
    data, lengths = memoryview(held.buffers()[2] or b""), np.diff(ends).astype(np.int32)
    found, starts = np.unique(bucket[order], return_index=True)
    rows = []
    for of, start, end in zip(found, starts, [*starts[1:], len(order)]):
        text = pa.compress(data[ends[start] : ends[end]], codec="zstd", asbytes=True)
        rows.append((part, of, end - start, _squeezed(ids[start:end]), _squeezed(lengths[start:end]), text, _squeezed(counts[start:end])))
    return _batch(rows, PACKED)


def _read_labels(batches, labels: dict):
    """The batches (text, id, label) without their labels, which are kept by id; null ids have none."""
    for batch in batches:
        for key, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key is not None:
                labels.setdefault(key, []).append(label)
        yield batch.select([0, 1])


def _pack_counts(lo: int, hi: int, buckets: int, labelled: bool = False):
    """With labels, a row of no pairs has (id, label) of the partition's rows in place of ids."""

    def run(batches):
        part, labels = TaskContext.get().partitionId(), {}
        if labelled:
            batches = _read_labels(batches, labels)
        for _, heads, sizes, terms, counts in _counted(batches, lo, hi, False, PAIRS):
            if terms:
                ids = _id_bytes(pa.array([h[0] for h in heads], pa.int64()).take(pa.array(np.repeat(np.arange(len(heads)), sizes))))
                yield _packed(part, ids, terms, np.array(counts, np.int64), buckets)
        if labels:
            flat = pa.table({"id": pa.array(list(labels)).take(pa.array(np.repeat(np.arange(len(labels)), [len(x) for x in labels.values()]))), "label": [x for held in labels.values() for x in held]})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, flat.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(flat)
            yield _batch([(part, part % buckets, 0, sink.getvalue().to_pybytes(), b"", b"", b"")], PACKED)

    return run


def _pack_vocabulary(buckets: int):
    def run(batches):
        held = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(x.num_rows for x in held) >= PAIRS:
                yield from pack(held)
                held = []
        if held:
            yield from pack(held)

    def pack(held):
        table = pa.Table.from_batches(held)
        ids = _id_bytes(table["feature_id"].combine_chunks())
        yield _packed(VOCABULARY, ids, table["term"].to_pylist(), np.zeros(len(ids), np.int64), buckets)

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def packed_pairs(prepared: DataFrame, partitions: int, id_col: str = "id", text_col: str = "ticket_text_clean", ngram_range=NGRAM_RANGE, label: str | None = None) -> DataFrame:
    """The counts of ``text_term_frequency`` by ranges (``partitions`` of them) of the terms' hashes, as compressed rows; ids are longs."""
    held = [] if label is None else [label]
    rows = prepared.select(text_col, F.col(id_col).cast("long").alias(id_col), *held).sortWithinPartitions(id_col)
    return rows.mapInArrow(_pack_counts(*ngram_range, partitions, bool(held)), PACKED)


def _by_bucket(packed: DataFrame, partitions: int) -> DataFrame:
    return packed.repartition(partitions, "bucket").sortWithinPartitions("bucket")


def _runs(batches, key: str):
    """The rows, as lists of dicts, of each value of the key by which they are sorted."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != last:
                yield held
                held = []
            held.append(row)
            last = row[key]
    if held:
        yield held


def _merged_terms(rows: list[dict]) -> pa.DictionaryArray:
    lengths = [_loosened(r["lengths"], r["n"], np.int32) for r in rows]
    texts = [pa.decompress(r["terms"], int(n.sum()), codec="zstd", asbytes=True) for r, n in zip(rows, lengths, strict=True)]
    return _terms(lengths, texts).dictionary_encode()


def _add_frequencies(indexed: bool):
    """Packed pairs with their terms' document frequencies or, ``indexed``, with those and feature ids in place of the terms."""

    def run(batches):
        for rows in _runs(batches, "bucket"):
            out = [(r["part"], 0, r["ids"], b"", b"", b"", b"", b"") for r in rows if not r["n"]]  # labels
            rows = [r for r in rows if r["n"]]
            if not rows:
                yield _batch(out, WEIGHED)
                continue
            found = _merged_terms(rows)
            codes, pairs = found.indices.to_numpy(zero_copy_only=False), np.repeat([r["part"] != VOCABULARY for r in rows], [r["n"] for r in rows])
            df = np.bincount(codes[pairs], minlength=len(found.dictionary)).astype(np.int64)[codes]
            feature, first = np.full(len(found.dictionary), -1, np.int64), 0
            if indexed:
                held = [_loosened(r["ids"], r["n"], _ID)["value"] for r in rows if r["part"] == VOCABULARY]
                feature[codes[~pairs]] = np.concatenate(held) if held else 0
            for r in rows:
                own, first = slice(first, first + r["n"]), first + r["n"]
                if r["part"] != VOCABULARY:
                    of = (b"", b"", r["tf"], _squeezed(df[own]), _squeezed(feature[codes[own]])) if indexed else (r["lengths"], r["terms"], r["tf"], _squeezed(df[own]), b"")
                    out.append((r["part"], r["n"], r["ids"], *of))
            if out:
                yield _batch(out, WEIGHED)

    return run


def _sum_terms(batches):
    for rows in _runs(batches, "bucket"):
        found = _merged_terms(rows)
        codes, n = found.indices.to_numpy(zero_copy_only=False), len(found.dictionary)
        totals = np.zeros(n, np.int64)
        np.add.at(totals, codes, np.concatenate([_loosened(r["tf"], r["n"], np.int64) for r in rows]))
        arrays = [found.dictionary.cast(pa.string()), pa.array(np.bincount(codes, minlength=n).astype(np.int64)), pa.array(totals)]
        whole = pa.RecordBatch.from_arrays(arrays, names=["term", "df", "corpus_tf"])
        yield from (whole.slice(first, ROWS) for first in range(0, n, ROWS))


def packed_document_frequency(packed: DataFrame, partitions: int) -> DataFrame:
    """(term, df, corpus_tf) of packed pairs: ``document_frequency`` without a row a pair."""
    return _by_bucket(packed, partitions).mapInArrow(_sum_terms, "term string, df long, corpus_tf long")


def _own_terms(row: dict) -> pa.Array:
    lengths = _loosened(row["lengths"], row["n"], np.int32)
    return _terms([lengths], [pa.decompress(row["terms"], int(lengths.sum()), codec="zstd", asbytes=True)])


def _labels_of(ids: pa.Array, named: list[bytes]):
    """(names, label codes, first one of each id, how many it has)."""
    if not named:
        return pa.array([], pa.string()), np.zeros(0, int), np.zeros(len(ids), int), np.zeros(len(ids), int)
    table = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in named])
    at = pc.index_in(table["id"].combine_chunks().cast(pa.int64()), value_set=ids)
    known = at.is_valid().to_numpy(zero_copy_only=False)  # an id without terms is not among the pairs'
    at, coded = at.drop_null().to_numpy(), table["label"].combine_chunks().cast(pa.string()).dictionary_encode()
    order, many = np.argsort(at, kind="stable"), np.bincount(at, minlength=len(ids))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)[known][order], np.cumsum(many) - many, many


def _label_sums(row: dict, docs: np.ndarray, weights: np.ndarray, some: np.ndarray, names: pa.Array, codes: np.ndarray, first: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    terms = _own_terms(row).filter(pa.array(some)).dictionary_encode()
    times = many[docs]
    at = np.repeat(np.arange(len(docs)), times)
    of = codes[first[docs][at] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)]
    keys, back = np.unique(terms.indices.to_numpy(zero_copy_only=False)[at].astype(np.int64) * max(1, len(names)) + of, return_inverse=True)
    term, name = np.divmod(keys, max(1, len(names)))
    columns = [names.take(pa.array(name)), terms.dictionary.take(pa.array(term)).cast(pa.string()), pa.array(np.bincount(back, weights=weights[at], minlength=len(keys)))]
    return pa.RecordBatch.from_arrays(columns, names=["label", "term", "weight"])


def packed_tfidf_l2(prepared: DataFrame, n_docs, partitions: int, min_df: int = MIN_DF, max_df: float = MAX_DF, id_col: str = "id", vocabulary: DataFrame | None = None, label: str | None = None) -> DataFrame:
    """(id, term, tf, weight) of prepared texts by packed pairs: ``tfidf_l2`` with ``idf_table`` of the same pairs.

    With a ``vocabulary`` (term, feature_id): (id, feature_id, weight) of its terms.
    With a column ``label``: (label, term, weight), partial sums over the rows with the
    label, a row of the texts being met by all pairs of its id; null ids meet none.

    A term's frequency goes back to the text partition its pairs came from, whose
    documents are whole there: norms need no window over the pairs.
    """

    def weigh(batches):
        for rows in _runs(batches, "part"):
            n, ids, raw, kept, named = float(rows[0]["_n"]), [], [], [], [r["ids"] for r in rows if not r["n"]]
            rows = [r for r in rows if r["n"]]
            if not rows:
                continue
            hi, lo = (m if isinstance(m, int) else m * n for m in (max_df, min_df))
            for r in rows:
                df = _loosened(r["df"], r["n"], np.int64)
                w = _loosened(r["tf"], r["n"], np.int64) * (np.log((1.0 + n) / (1.0 + df)) + 1.0)
                kept.append((df <= hi) & (df >= lo))
                ids.append(_loosened(r["ids"], r["n"], _ID))
                raw.append(np.where(kept[-1], w, 0.0))
            every = np.concatenate(ids)
            of = pa.array(every["value"], mask=every["null"] > 0).dictionary_encode("encode")
            if label is not None:
                labels = _labels_of(of.dictionary, named)
            of = of.indices.to_numpy()
            norm = np.sqrt(np.bincount(of, weights=np.concatenate(raw) ** 2))[of]
            first = 0
            for r, own, w, some in zip(rows, ids, raw, kept, strict=True):
                norms, docs, first = norm[first : first + r["n"]], of[first : first + r["n"]], first + r["n"]
                if label is not None:
                    yield _label_sums(r, docs[some], (w[some] / norms[some]), some, *labels)
                    continue
                if indexed:
                    feature = _loosened(r["feature"], r["n"], np.int64)
                    columns, some = [pa.array(feature)], some & (feature >= 0)
                else:
                    columns = [_own_terms(r).cast(pa.string()), pa.array(_loosened(r["tf"], r["n"], np.int64))]
                with np.errstate(invalid="ignore"):
                    columns = [pa.array(own["value"], mask=own["null"] > 0), *columns, pa.array(w / norms)]
                batch = pa.RecordBatch.from_arrays(columns, names=names)
                yield batch if some.all() else batch.filter(pa.array(some))

    indexed, packed = vocabulary is not None, packed_pairs(prepared, partitions, id_col, label=label)
    names = [id_col, "feature_id", "weight"] if indexed else [id_col, "term", "tf", "weight"]
    if indexed:
        packed = packed.unionByName(vocabulary.select("term", F.col("feature_id").cast("long").alias("feature_id")).mapInArrow(_pack_vocabulary(partitions), PACKED))
    weighed = _by_bucket(packed, partitions).mapInArrow(_add_frequencies(indexed), WEIGHED).repartition(partitions, "part").sortWithinPartitions("part")
    schema = f"{id_col} long, feature_id long, weight double" if indexed else f"{id_col} long, term string, tf long, weight double"
    if label is not None:
        schema = f"{label} string, term string, weight double"
    return weighed.withColumn("_n", n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)).mapInArrow(weigh, schema)


_ID = np.dtype([("value", "<i8"), ("null", "u1")])


def by_term(tf: DataFrame) -> DataFrame:
    """The pairs exchanged by term: ``idf_table(…, whole=True)`` and joins with it share that one exchange."""
    return tf.repartition("term")


def document_frequency(tf: DataFrame, whole: bool = False, totals: bool = False) -> DataFrame:
    """(term, df): number of documents containing the term; ``totals``: and corpus_tf, how often it occurs.

    ``whole`` reads every column of the pairs, as a join with them does: with fewer
    columns Spark would exchange them a second time.
    """
    count = F.count(F.lit(1))
    if whole:
        none = [F.col(c).isNull() for c in tf.columns if c != "term"]
        count = F.sum(F.when(reduce(lambda a, b: a & b, none), F.lit(0)).otherwise(F.lit(1)))
    return tf.groupBy("term").agg(count.alias("df"), *([F.sum("tf").alias("corpus_tf")] if totals else []))


def corpus_size(docs: DataFrame):
    """Number of documents as a lazy scalar subquery column."""
    return docs.select(F.count(F.lit(1))).scalar()


def idf_table(tf: DataFrame, n_docs, min_df: int = MIN_DF, max_df: float = MAX_DF, whole: bool = False, totals: bool = False) -> DataFrame:
    """(term, df[, corpus_tf], idf) after min/max df pruning; idf = ln((1+n)/(1+df)) + 1.

    ``max_df`` as a float is a proportion of n (inclusive edge), as an int an
    absolute count; ``min_df`` likewise. ``whole``, ``totals``: as of ``document_frequency``.
    """
    return idf_of(document_frequency(tf, whole, totals), n_docs, min_df, max_df)


def idf_of(dfs: DataFrame, n_docs, min_df: int = MIN_DF, max_df: float = MAX_DF) -> DataFrame:
    """``idf_table`` of the terms' document frequencies."""
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(float(max_df)) * n
    lo = F.lit(min_df) if isinstance(min_df, int) else F.lit(float(min_df)) * n
    return dfs.where((F.col("df") <= hi) & (F.col("df") >= lo)).withColumn(
        "idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    )


def tfidf_l2(tf: DataFrame, idf: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, term, tf, weight): tf·idf divided by the row's L2 norm.

    Terms missing from ``idf`` (pruned or unseen) are dropped by the inner
    join; rows whose terms are all dropped simply have no entries.
    """
    raw = tf.join(idf.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # One pass over the joined rows: the norm is a window sum by document, so
    # the join with idf is not computed a second time for the norms.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "tf", (F.col("w") / norm).alias("weight"))


def vocabulary_index(idf: DataFrame, checkpoint: bool = True) -> DataFrame:
    """(term, feature_id): position of the term in code-point order, 0-based.

    A global sort range-partitions the terms; feature_id = rows in earlier
    partitions + position inside the partition. The per-partition counts are
    one row per partition (bounded by the partition count, not the data).
    The sorted table is written to the shared checkpoint folder so both
    passes see the same partitioning; sorted terms take a few bytes each there.
    """
    ordered = idf.select("term").orderBy("term").withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        path = scratch_path(idf.sparkSession, "vocabulary")
        ordered.write.option("compression", "zstd").parquet(path)
        ordered = idf.sparkSession.read.parquet(path)
    part = (F.col("_mid") / F.lit(1 << 33)).cast("long")
    local = F.col("_mid") - part * F.lit(1 << 33)
    ordered = ordered.withColumn("_part", part).withColumn("_local", local)
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_offset",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_part", "_offset")
    return ordered.join(F.broadcast(offsets), "_part").select(
        "term", (F.col("_offset") + F.col("_local")).alias("feature_id")
    )


def vocabulary_topk(tf: DataFrame, idf: DataFrame, k: int) -> DataFrame:
    """max_features: the k pruned terms with the largest corpus count (ties: term).

    A top-k with a fixed k: each task keeps its own k best, then one merge. Totals
    that ``idf`` has already are not summed again.
    """
    if "corpus_tf" in idf.columns:
        kept = idf.select("term", "corpus_tf")
    else:
        kept = tf.groupBy("term").agg(F.sum("tf").alias("corpus_tf")).join(idf.select("term"), "term")
    return kept.orderBy(F.col("corpus_tf").desc(), F.col("term").asc()).limit(k)


def exact_entries(weights: DataFrame, vocabulary: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, entries): a document's (feature_id, weight) pairs in column order.

    The vocabulary stays a table: a term becomes its column by a join, one row
    per (document, term), and a sorted aggregate puts a document's entries together.
    Weights that have their columns already are not joined.
    """
    indexed = weights if "feature_id" in weights.columns else weights.join(vocabulary.select("term", "feature_id"), "term")
    return indexed.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col("feature_id").cast("int").alias("feature_id"), "weight"))).alias("entries"))


def exact_vectors(weights: DataFrame, vocabulary: DataFrame, ids: DataFrame, size: int, id_col: str = "id", out_col: str = "features") -> DataFrame:
    """``ids`` with a sparse vector of ``size`` columns; a row without known terms has an empty one.

    Spark SQL has no function that makes a sparse vector, so the struct a vector
    consists of passes through one Arrow step that only changes its type.
    """
    rows = ids.join(exact_entries(weights, vocabulary, id_col), id_col, "left")
    entries = F.coalesce(F.col("entries"), F.array().cast("array<struct<feature_id:int,weight:double>>"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(int(size)).alias("size"),
        F.transform(entries, lambda e: e["feature_id"]).alias("indices"), F.transform(entries, lambda e: e["weight"]).alias("values"),
    )
    flat = rows.select(*ids.columns, vector.alias(out_col))
    schema = T.StructType([f for f in flat.schema if f.name != out_col] + [T.StructField(out_col, VectorUDT(), True)])
    return flat.mapInArrow(lambda batches: batches, schema)


def length_feature(prepared: DataFrame, train_flag: str | None = None, length_col: str = "ticket_text_length"):
    """length / max(train max length, 1.0), the max taken over training rows only."""
    base = prepared if train_flag is None else prepared.where(F.col(train_flag))
    scale = base.select(F.greatest(F.max(F.col(length_col).cast("double")), F.lit(1.0))).scalar()
    return prepared.withColumn("length_feature", F.col(length_col).cast("double") / scale)


def fold_idf_tables(tf: DataFrame, folds: DataFrame, n_folds: int, id_col: str = "id", max_df: float = MAX_DF) -> DataFrame:
    """(fold, term, df, idf) of the training side of every fold, in one pass.

    The training df of fold f is the total df minus the df inside f, so one
    aggregate per term with k conditional counts (partial + final, keyed by
    the term) replaces k scans of the corpus. Training sizes come from the
    k per-fold document counts (k rows). Pairs that carry the folds of their id
    (an array ``folds``) are not joined with them.
    """
    if "folds" in tf.columns:
        tagged = tf.select("term", F.explode("folds").alias("fold"))
    else:
        tagged = tf.select(id_col, "term").join(folds.select(id_col, "fold"), id_col)
    per_term = tagged.groupBy("term").agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(F.col("fold") == f, 1)).alias(f"_in{f}") for f in range(1, n_folds + 1)],
    )
    exploded = per_term.select(
        "term",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("fold"), (F.col("_total") - F.col(f"_in{f}")).alias("df"))
                    for f in range(1, n_folds + 1)
                ]
            )
        ),
    ).where(F.col("df") > 0)
    sizes = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("_n_in"))
    total = folds.select(F.count(F.lit(1))).scalar()
    train = sizes.select("fold", (total - F.col("_n_in")).alias("_n"))
    out = exploded.join(F.broadcast(train), "fold")  # k rows
    out = out.where(F.col("df") <= F.lit(float(max_df)) * F.col("_n"))
    idf = F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return out.select(F.col("fold").cast("int").alias("fold"), "term", "df", idf.alias("idf"))
