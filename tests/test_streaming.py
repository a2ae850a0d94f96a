"""Restarts of the ingest: nothing is lost and nothing is stored twice."""

import json

from pyspark.sql import functions as F

from textloom.sources.readers import fragments
from textloom.streaming.ingest import landed_stream, store_batches


def land(path, name, keys):
    path.mkdir(exist_ok=True)
    lines = [json.dumps({"source": "s", "doc_key": k, "text": f"text of {k} " * 10}) for k in keys]
    (path / name).write_text("\n".join(lines))


def test_restarts(spark, tmp_path):
    landing = tmp_path / "landing"
    store, ledger = str(tmp_path / "store"), str(tmp_path / "ledger")

    def run():
        def cut(batch):
            return fragments(batch, F.col("source"), F.col("doc_key"), F.array("text", F.lit("short")))

        stream = landed_stream(spark, str(landing), files_per_batch=1)
        store_batches(stream, cut, store, ledger, str(tmp_path / "progress")).awaitTermination()
        return sorted(r.doc_key for r in spark.read.parquet(store).collect())

    land(landing, "a.json", ["k1", "k2"])
    assert run() == ["k1", "k2"]
    assert run() == ["k1", "k2"]
    land(landing, "b.json", ["k2", "k3"])  # k2 lands again
    land(landing, "c.json", ["k4"])
    assert run() == ["k1", "k2", "k3", "k4"]
    assert spark.read.parquet(ledger).select("batch").distinct().count() == 3


def test_files_per_batch_do_not_matter(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", ["k1", "k2"])
    (landing / "b.json").write_text((landing / "a.json").read_text().replace("text of", "later text of"))
    got = []
    for files in (1, 10):
        store = str(tmp_path / f"store{files}")

        def cut(batch):
            return fragments(batch, F.col("source"), F.col("doc_key"), F.array("text"))

        stream = landed_stream(spark, str(landing), files_per_batch=files)
        store_batches(stream, cut, store, f"{store}-ledger", f"{store}-progress").awaitTermination()
        got.append(sorted((r.doc_key, r.text) for r in spark.read.parquet(store).collect()))
    assert got[0] == got[1] and [k for k, _ in got[0]] == ["k1", "k2"] and "later" not in got[0][0][1]


def test_repeated_keys_in_a_later_batch(spark, tmp_path):
    """Two files of a later batch hold the same new key, and rows without a key come with each."""
    landing = tmp_path / "landing"
    store, ledger = str(tmp_path / "store"), str(tmp_path / "ledger")

    def run():
        def cut(batch):
            return fragments(batch, F.col("source"), F.col("doc_key"), F.array("text"))

        stream = landed_stream(spark, str(landing), files_per_batch=10)
        store_batches(stream, cut, store, ledger, str(tmp_path / "progress")).awaitTermination()
        return sorted((str(r.doc_key), "later" in r.text) for r in spark.read.parquet(store).collect())

    land(landing, "a.json", ["k1", None])
    assert run() == [("None", False), ("k1", False)]
    land(landing, "b.json", ["k2", "k1", None])
    for name in ("c.json", "d.json"):
        (landing / name).write_text((landing / "b.json").read_text().replace("text of", "later text of"))
    assert run() == [("None", False), ("None", False), ("None", True), ("None", True), ("k1", False), ("k2", False)]
    assert sorted(r.key for r in spark.read.parquet(ledger).collect()) == ["k1", "k2"]


def test_keys_without_their_texts_in_the_state(spark, tmp_path):
    """The state holds keys and files only; of a key in one file twice the smallest row stays, and names of files are no patterns."""
    landing = tmp_path / "landing"
    store, ledger, progress = (str(tmp_path / n) for n in ("store", "ledger", "progress"))
    landing.mkdir()
    rows = [("s", "k", "z" * 30), ("s", "k", "unique-words " * 5), (None, "k", "other source " * 5), (None, "k", None)]
    lines = [json.dumps(dict(zip(("source", "doc_key", "text"), r, strict=True))) for r in rows]
    (landing / "a b [1].json").write_text("\n".join(lines))

    def cut(batch):
        return fragments(batch, F.col("source"), F.col("doc_key"), F.array(F.coalesce("text", F.lit("nothing " * 10))))

    stream = landed_stream(spark, str(landing))
    store_batches(stream, cut, store, ledger, progress).awaitTermination()
    found = {(r.source, r.doc_key): r.text for r in spark.read.parquet(store).collect()}
    assert found == {("s", "k"): "unique-words " * 5, (None, "k"): "nothing " * 10}
    states = [p.read_bytes() for p in (tmp_path / "progress" / "state").rglob("*") if p.is_file()]
    assert states and not any(b"unique-words" in s for s in states)


def test_landed_files_grow_with_the_splits(spark, sf_dir, tmp_path):
    from textloom.queries import streams

    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        times = streams.land(spark, str(tmp_path), str(tmp_path / "landing"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert times >= 3 and len(list((tmp_path / "landing").glob("part-*"))) == 4 * times
