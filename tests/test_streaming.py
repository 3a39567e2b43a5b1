"""Streaming triage: restart with the same checkpoint adds nothing twice."""

from pyspark.sql import functions as F

from ticketlens.plans import views as V
from ticketlens.streaming import triage as st


def test_restart_is_idempotent_and_incremental(spark, sf_dir, tmp_path):
    requests = V.tickets(spark, sf_dir, False)
    total = requests.count()
    src = st.write_request_files(requests, str(tmp_path / "src"))
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")

    def scorer(batch):
        return batch.select("id", F.length("body").alias("n"))

    acc, rej = st.run_triage_stream(spark, src, scorer, sink, ckpt)
    n_acc, n_rej = spark.read.parquet(acc).count(), spark.read.parquet(rej).count()
    assert n_acc + n_rej == total and n_acc > 0

    st.run_triage_stream(spark, src, scorer, sink, ckpt)  # nothing new
    assert spark.read.parquet(acc).count() == n_acc

    extra = requests.limit(3).withColumn("id", F.col("id") + F.lit(10**9))
    extra.select("id", "subject", "body", "language").write.mode("append").parquet(src)
    st.run_triage_stream(spark, src, scorer, sink, ckpt)  # only the new file
    after = spark.read.parquet(acc).count() + spark.read.parquet(rej).count()
    assert after == total + 3
    ids = [r.id for r in spark.read.parquet(acc).select("id").collect()]
    assert len(ids) == len(set(ids))


def test_streamed_model_scores_equal_batch(spark, sf_dir):
    import __spark_entry__ as entry

    q = entry.queries()
    batch = {r.id: tuple(r)[1:] for r in q["triage_batch"](spark, sf_dir).collect()}
    streamed = {r.id: tuple(r)[1:] for r in q["streaming_model_triage"](spark, sf_dir).collect()}
    assert streamed and set(streamed) <= set(batch)
    for i, row in streamed.items():
        b = batch[i]
        assert (row[0], row[1], row[3], row[4]) == (b[0], b[1], b[3], b[4])
        assert abs(row[2] - b[2]) < 1e-6 and abs(row[5] - b[5]) < 1e-6


def test_repeated_and_null_ids_stay_rows(spark):
    from ticketlens.streaming import triage as st

    model = spark.createDataFrame([("printer", 1.5, [2.0, -1.0]), ("salary", 1.2, [-1.0, 3.0])], "term string, idf double, coefs array<double>")
    rows = [(1, "a", "printer"), (1, "b", "salary"), (None, "c", "salary salary"), (2, "", "x"), (3, "nothing", "known")]
    batch = spark.createDataFrame(rows, "id long, subject string, body string").repartition(3)
    got = sorted((repr(r.id), r.label) for r in st.relational_scorer(model, [0.1, 0.0], ["it", "pay"])(batch).collect())
    assert got == [("1", "it"), ("1", "pay"), ("2", "it"), ("3", "it"), ("None", "pay")]


def test_promotion_reaches_the_next_epoch(spark, tmp_path):
    """One stream, a file an epoch; the second scorer is promoted while the first epoch is written."""
    from ticketlens.operators import runs as rn
    from ticketlens.streaming import triage as st

    store, loaded = str(tmp_path / "store"), []

    def promote(name):
        rn.promote(spark, store, spark.createDataFrame([("triage", name)], "task string, run_id string"))

    def load(promoted):
        loaded.append(promoted.first().run_id)
        return lambda batch: batch.selectExpr("id", f"'{loaded[-1]}' as label")

    follow = st.promoted_scorer(spark, store, load)

    def score(batch):
        out = follow(batch)
        promote("second")
        return out

    requests = spark.createDataFrame([(i, "s", "b" if i else "", None) for i in range(9)], "id long, subject string, body string, language string")
    source = str(tmp_path / "requests")
    requests.repartition(3).write.parquet(source)
    promote("first")
    accepted, rejected = st.run_triage_stream(spark, source, score, str(tmp_path / "sink"), str(tmp_path / "check"), max_files_per_trigger=1)
    labels = {(r.epoch, r.label) for r in spark.read.parquet(accepted).collect()}
    assert {e for e, _ in labels} == {0, 1, 2} and {x for e, x in labels if e == 0} == {"first"} and {x for e, x in labels if e} == {"second"}
    assert loaded == ["first", "second", "second"][: len(loaded)] and len(loaded) >= 2
    counts = {r.epoch: (r.requests, r.accepted, r.rejected) for r in spark.read.parquet(str(tmp_path / "sink" / "counts")).collect()}
    for epoch, (n, a, b) in counts.items():
        assert a == spark.read.parquet(accepted).where(f"epoch = {epoch}").count() and b == spark.read.parquet(rejected).where(f"epoch = {epoch}").count() and n == a + b
    assert sum(n for n, _, _ in counts.values()) == 9 and sum(b for _, _, b in counts.values()) == 1
