"""All six sources from files to the dataset, run twice."""

import io
import json
import zipfile

import pytest

from textloom.plans.chain import checked_vocabulary, prepare_training
from textloom.plans.sources import build_corpus
from textloom.sources.readers import read_jsonl

WORDS = "palabra " * 40


def landed_files(folder):
    paths = {}
    for name in ("wikipedia", "gutenberg", "codigo_local", "codigo_github", "dialogos_naturales", "opensubtitles_es"):
        (folder / name).mkdir(parents=True)
        paths[name] = str(folder / name)
    for i in range(3):
        payload = {"query": {"pages": {str(i): {"extract": f"Artículo {i}. {WORDS}"}}}}
        (folder / "wikipedia" / f"{i}.json").write_text(json.dumps(payload))
        (folder / "gutenberg" / f"{i}-0.txt").write_text(f"Libro {i}. {WORDS}")
        (folder / "codigo_local" / f"f{i}.py").write_text("\n".join(f"x{j} = {i}" for j in range(60)))
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("r/a.py", "\n".join(f"y{j} = {i}" for j in range(60)))
        (folder / "codigo_github" / f"me__repo{i}.zip").write_bytes(buffer.getvalue())
    pairs = [{"id": i, "translation": {"es": f"Frase número {i} " * 5, "en": "x"}} for i in range(4)]
    for name in ("dialogos_naturales", "opensubtitles_es"):
        (folder / name / "pairs.json").write_text("\n".join(map(json.dumps, pairs)))
    return paths


def test_all_sources(spark, tmp_path):
    landed = landed_files(tmp_path / "landed")
    store, output = str(tmp_path / "store"), str(tmp_path / "dataset")
    for _ in range(2):  # the second run finds nothing new
        counts = {r.source: r.fragments for r in build_corpus(spark, landed, store, output).collect()}
        assert counts == {
            "wikipedia": 3, "gutenberg": 3, "codigo_local": 3, "codigo_github": 3, "dialogos_naturales": 4,
            "opensubtitles_es": 4, None: 20,
        }
    assert read_jsonl(spark, output).filter("text IS NOT NULL").count() == 20
    quotas = {"wikipedia": 1, "dialogos_naturales": 2}
    build_corpus(spark, landed, store, output, quotas)
    assert read_jsonl(spark, output).count() == 3


def test_inputs_without_fragments_are_read_once(spark, tmp_path):
    landed = {"wikipedia": landed_files(tmp_path / "landed")["wikipedia"]}
    folder = tmp_path / "landed" / "wikipedia"
    (folder / "short.json").write_text(json.dumps({"query": {"pages": {"7": {"extract": "corto"}}}}))
    store, output = str(tmp_path / "store"), str(tmp_path / "dataset")
    first, second = (build_corpus(spark, landed, store, output).filter("source IS NOT NULL").first() for _ in range(2))
    assert (first.succeeded, first.failed) == (3, 1)
    assert (second.succeeded, second.failed, second.fragments) == (0, 0, 3)


def test_caps_hold_over_runs(spark, tmp_path):
    landed = landed_files(tmp_path / "landed")
    store, output = str(tmp_path / "store"), str(tmp_path / "dataset")
    caps = {"codigo_github": 1, "dialogos_naturales": 2, "codigo_local": 0}
    for _ in range(2):
        report = {r.source: r for r in build_corpus(spark, landed, store, output, caps=caps).collect()}
        assert report["codigo_github"].fragments == 1 and report["dialogos_naturales"].fragments == 2
        assert report["codigo_local"].fragments == 0 and report["codigo_local"].pending == 3 and report["wikipedia"].fragments == 3
    assert spark.read.parquet(f"{output}-keyed").count() == report[None].fragments


def test_chain_to_training_rows(spark, tmp_path):
    landed = landed_files(tmp_path / "landed")
    output = tmp_path / "out"
    report = prepare_training(spark, landed, str(tmp_path / "store"), str(output), ranks=2, batch_size=2, size=300, min_frequency=2)
    assert {r.source: r.fragments for r in report.collect()}[None] == 20
    rows = spark.read.parquet(str(output / "rows"))
    assert rows.filter("split = 'train'").count() == 16  # of 18 rows, nine a rank, in whole batches of two
    for folder in (output / "rows").glob("split=train/rank=*"):
        slots = [r.slot for f in sorted(folder.glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert slots == sorted(slots) and len(slots) == 8
    assert spark.read.parquet(str(output / "vocabulary")).count() <= 300


def test_vocabulary_is_checked(spark):
    bad = spark.createDataFrame([(0, "<unk>"), (1, "<pad>")], "id int, token string")
    with pytest.raises(ValueError, match="reserved tokens"):
        checked_vocabulary(bad)
