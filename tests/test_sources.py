"""Readers and sinks on real files."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from textloom.functions.vectors import cosine
from textloom.operators import reports, select
from textloom.plans import sources
from textloom.plans.tuning import repaired_lines
from textloom.sources import readers, sinks
from textloom.sources import reference_values as ref


def test_json_lines(spark, tmp_path):
    lines = [
        '{"text":"a"}', '{"text":"a"} xx', '{"text":"a"}}', '{"text":"a","b":[1]}', "null", "[1]", '"x"', '{"b":1}',
        '{"text":"a\\<b"}', '{"text":"\\u00e9 \\ud83d\\ude00"}', '{"text":"tab\tin"}', "", '{"text":"x","text":"y"}',
        "{'text':'x'}", '{text:"a"}', '{"text":"a"},{"text":"b"}',
    ]
    (tmp_path / "lines.jsonl").write_text("\n".join(lines), encoding="utf-8")

    def parsed(line):
        try:
            return json.loads(line)["text"]
        except (ValueError, KeyError, TypeError):
            return None

    found = {r["value"]: r.text for r in readers.read_jsonl(spark, str(tmp_path / "lines.jsonl")).collect()}
    assert found == {line: parsed(line) for line in lines}


def test_article_payloads(spark):
    payloads = [
        '{"query":{"pages":{"12":{"extract":"Hola\\n\\nmundo"}}}}', '{"query":{"pages":{"-1":{"extract":"x"}}}}',
        '{"query":{"pages":{"5":{}}}}', '{"query":{"pages":{"5":{"extract":" \\n"}}}}', "bad",
        '{"query":{"pages":{"7":{"extract":"a"},"-1":{}}}}',
    ]
    rows = spark.createDataFrame([(p,) for p in payloads], "p string")
    found = [r.t for r in rows.select(readers.article_text(F.col("p")).alias("t")).collect()]
    assert found == ["Hola\n\nmundo", None, None, None, None, "a"]


def test_books(spark, tmp_path):
    body = "\n\n".join(f"Paragraph {i} " + "word " * 40 for i in range(5))
    (tmp_path / "10-0.txt").write_bytes(b"too short")
    (tmp_path / "10-1.txt").write_bytes(b"\xff" + body.encode() + b"\xfe")
    (tmp_path / "11-0.txt").write_bytes(body.encode())
    (tmp_path / "11-1.txt").write_bytes(("other " * 100).encode())
    (tmp_path / "12-0.txt").write_bytes(b"nothing")
    rows = readers.book_fragments(readers.read_books(spark, str(tmp_path))).collect()
    assert {r.doc_key for r in rows} == {"10", "11"}
    texts = {r.doc_key: r.text for r in rows}
    assert texts["10"] == texts["11"] and texts["11"].startswith("Paragraph 0")


def test_code_tree(spark, tmp_path):
    content = "\n".join(f"line {i} of a file" for i in range(20))
    kept = {"src/a.py", "src/B.JSON", "top.md"}
    dropped = {"layout/a.py", "src/node_modules/x.js", "src/x.min.js", "src/yarn.lock", "src/bundle.js", "src/readme.txt"}
    for name in kept | dropped:
        path = tmp_path / "code" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    (tmp_path / "code" / "src" / "short.py").write_text("x\n" * 6)
    (tmp_path / "code" / "src" / "one_line.py").write_text("y" * 500)
    root = f"{tmp_path}/code"
    files = readers.code_tree_files(readers.read_code_tree(spark, root, judge_root=False), root="")
    rows = readers.code_tree_fragments(files).collect()
    assert {r.doc_key for r in rows} == kept
    json_file = next(r.text for r in rows if r.doc_key == "src/B.JSON")
    assert json_file.startswith("# Archivo: B.JSON (extension: .json)\n\nline 0")


def test_code_tree_judges_the_root_too(spark, tmp_path):
    (tmp_path / "build" / "src").mkdir(parents=True)
    for name in ("build/a.py", "build/src/a.py"):
        (tmp_path / name).write_text("x")
    found = [r.path for r in readers.read_code_tree(spark, str(tmp_path / "build")).collect()]
    assert [p.split("/")[-2:] for p in found] == [["build", "a.py"]]


def archive(files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    long = "some code line\n" * 20
    (tmp_path / "me__many.zip").write_bytes(archive({f"r/f{i}.py": long for i in range(80)}))
    (tmp_path / "me__few.zip").write_bytes(
        archive({"r/a.PY": long, "r/tests/b.py": long, "r/vendor/c.go": long, "r/d.txt": long, "r/dir.py/": "",
                 "r/e.js": "x" * 200_001, "r/f.js": "tiny", "r/g.rs": b"\xff" + long.encode()})
    )
    (tmp_path / "me__bad.zip").write_bytes(b"not a zip")
    entries = readers.archive_entries(readers.read_archives(spark, str(tmp_path)), ref.FILES_PER_REPO)
    found = entries.groupBy("repo").count().collect()
    assert {r["repo"]: r["count"] for r in found} == {"many": ref.FILES_PER_REPO, "few": 3}
    every = readers.archive_entries(readers.read_archives(spark, str(tmp_path)))
    assert every.filter("repo = 'many'").count() == 80
    rows = readers.archive_fragments(entries.filter("repo = 'few'")).collect()
    assert {r.doc_key for r in rows} == {"me/few/r/a.PY", "me/few/r/g.rs"}
    assert all(r.text.startswith("# Repo: me/few | Archivo: ") for r in rows)


def test_damaged_entries_and_names(spark, tmp_path):
    """Only the damaged entries are lost; a repository's name may hold the separator."""
    long = "some code line\n" * 20
    good = {f"r/f{i}.py": long + str(i) for i in range(9)}
    for kind in ("checksum", "stream"):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED if kind == "checksum" else zipfile.ZIP_DEFLATED) as z:
            z.writestr("r/bad.py", "UNIQUE-MARK " * 30)
            for name, content in good.items():
                z.writestr(name, content)
        raw = bytearray(buffer.getvalue())
        at = raw.find(b"r/bad.py") + len("r/bad.py")
        raw[at + 2 : at + 8] = b"\xff" * 6
        (tmp_path / f"me__my__{kind}.zip").write_bytes(bytes(raw))
    entries = readers.archive_entries(readers.read_archives(spark, str(tmp_path))).collect()
    assert {(r.owner, r.repo) for r in entries} == {("me", "my__checksum"), ("me", "my__stream")}
    assert sorted(r.path for r in entries if r.repo == "my__stream") == sorted(good)
    assert sorted(r.path for r in entries if r.repo == "my__checksum") == sorted(good)


def test_branches(spark, tmp_path):
    long = "some code line\n" * 20
    for name, content in (("a@master", long), ("a@main", b"damaged"), ("b@main", long), ("b@master", long), ("c@dev", long), ("d", long), ("d@main", long)):
        raw = content if isinstance(content, bytes) else archive({f"r/{name}.py": content})
        (tmp_path / f"me__{name}.zip").write_bytes(raw)
    found = {(r.repo, r.path) for r in readers.archive_entries(readers.read_archives(spark, str(tmp_path))).collect()}
    assert found == {("a", "r/a@master.py"), ("b", "r/b@main.py"), ("d", "r/d.py")}


def test_archives_on_any_branch(spark, tmp_path):
    code = "value = compute(1)\n" * 30
    for name in ("a@develop", "b@7.1", "b@master", "c@canary", "c@main"):
        (tmp_path / f"me__{name}.zip").write_bytes(archive({f"r/{name.replace('@', '_')}.py": code}))
    named = spark.createDataFrame([("me", "c", "canary")], "owner string, repo string, branch string")
    paths = [str(p) for p in tmp_path.iterdir()]

    def keys(branches):
        return {r.doc_key for r in sources.archives(spark, paths, branches=branches).collect()}

    assert keys(None) == {"me/a/r/a_develop.py", "me/b/r/b_master.py", "me/c/r/c_main.py"}
    assert keys(named) == {"me/a/r/a_develop.py", "me/b/r/b_master.py", "me/c/r/c_canary.py"}


def test_line_ends_of_a_code_tree(spark, tmp_path):
    lines = [f"line {i} of the file" for i in range(40)]
    for name, end in (("lf", "\n"), ("crlf", "\r\n"), ("cr", "\r")):
        (tmp_path / f"{name}.py").write_bytes(end.join(lines).encode())
    files = readers.code_tree_files(readers.read_code_tree(spark, str(tmp_path), judge_root=False), root="")
    assert {r.path: r.content for r in files.collect()} == {f"{n}.py": "\n".join(lines) for n in ("lf", "crlf", "cr")}


def test_failed_replacement_keeps_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.replace_table(spark.range(3).toDF("id"), path)
    sinks.replace_table(spark.read.schema("id long").json(path).filter("id < 2"), path)
    assert spark.read.json(path).count() == 2


def test_catalogue_and_ledger(spark, tmp_path):
    titles = [{"ordinal": i, "title": f"T{i}"} for i in range(5)]
    (tmp_path / "titles.json").write_text("\n".join(map(json.dumps, titles)))
    read = readers.read_catalogue(spark, str(tmp_path / "titles.json"), "title string", 3)
    assert sorted(r.title for r in read.collect()) == ["T0", "T1", "T2"]
    for name, content, keys in [("ok", '["T0","T0","T1"]', {"T0", "T1"}), ("empty", "", set()), ("bad", '["T0"', set())]:
        (tmp_path / name).write_text(content)
        assert {r.key for r in readers.read_ledger(spark, str(tmp_path / name)).collect()} == keys
    assert readers.read_ledger(spark, str(tmp_path / "missing")).count() == 0
    assert readers.cache_present(spark, str(tmp_path / "ok"))
    assert not readers.cache_present(spark, str(tmp_path / "empty"))
    assert not readers.cache_present(spark, str(tmp_path / "missing"))


def test_pending_keeps_or_drops_duplicates(spark):
    work = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "key string")
    done = spark.createDataFrame([("b",)], "key string")
    assert sorted(r.key for r in select.pending(work, done, ["key"]).collect()) == ["a", "a", "c"]
    assert sorted(r.key for r in select.pending(work, done, ["key"], dedupe=True).collect()) == ["a", "c"]


def test_tuning_repair(spark):
    lines = [
        '{"text":"\\<human>: a\\n\\<assistant>: b\\!"}', '{"text":"no marks"}', "  ", '{"text": "x" "y"}',
        '{"text":"bad \\\\< escape"}',
    ]
    rows = repaired_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
    found = {r["value"]: (r.text, r.well_formed) for r in rows.collect()}
    assert found == {
        lines[0]: ("<human>: a\n<assistant>: b!", True),
        lines[1]: ("no marks", False),
        lines[3]: (None, False),
        lines[4]: (None, False),  # the repair also damages a valid escape
    }
    report = reports.tuning_report(rows).first()
    assert tuple(report) == (2, 1, 1, 2)


def test_dialogues_and_subtitles(spark):
    long = "una frase bastante larga para contar bien"
    rows = [(1, {"es": long}, None), (2, {"en": long}, long), (3, None, long), (4, None, None), (5, {"es": "​" * 50}, None),
            (6, {"es": " " * 30 + "corta" + " " * 30}, None)]
    pairs = spark.createDataFrame(rows, "id long, translation map<string,string>, text string")
    dialogue = {r.doc_key: r.text for r in readers.dialogue_fragments(pairs, "id").collect()}
    assert dialogue == {"1": long, "3": long, "5": "", "6": "corta"}
    subtitles = {r.doc_key: r.text for r in readers.subtitle_fragments(pairs, "id").collect()}
    assert subtitles == {"1": long}


def test_history_and_replace(spark, tmp_path):
    path = str(tmp_path / "history")
    one = spark.createDataFrame([(1, 2.0, 3.0, 4.0, 5.0)], sinks.HISTORY_SCHEMA)
    sinks.append_history(spark, one, path)
    sinks.append_history(spark, one.withColumn("epoch", F.lit(2)), path)
    assert sorted(r.epoch for r in spark.read.json(path).collect()) == [1, 2]
    sinks.replace_table(one, path)
    assert [r.epoch for r in spark.read.json(path).collect()] == [1]
    assert [p.name for p in tmp_path.iterdir()] == ["history"]


def test_rounding_is_of_the_binary_value(spark):
    values = [6.55, 0.5, 1.5, 2.675, 1e-9, -6.55]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.r for r in rows.select(reports.rounded(F.col("v"), 1).alias("r")).collect()] == [round(v, 1) for v in values]


def test_size_mismatch_fails(spark):
    import pytest

    left, right = spark.range(3), spark.range(4)
    assert select.require_same_size(left, left).first().size == 3
    with pytest.raises(Exception, match="vocabulary sizes differ: 3 and 4"):
        select.require_same_size(left, right).collect()


def test_cosine_of_zero_vector(spark):
    row = spark.sql("SELECT array(0.0D, 0.0D) a, array(1.0D, 2.0D) b")
    assert row.select(cosine(F.col("a"), F.col("b")).alias("c")).first().c == 0.0
    assert abs(row.select(cosine(F.col("b"), F.col("b")).alias("c")).first().c - 1.0) < 1e-12


def test_files_of_one_path_are_numbered_together(spark):
    def content(mark, blocks):
        return "\n\n".join("\n".join(f"{mark}{b} = {'x' * 80}  # {i}" for i in range(24)) for b in range(blocks))

    rows = [("t/a.py", content("first", 2)), ("t/a.py", content("second", 3)), ("t/b.py", content("only", 2))]
    files = spark.createDataFrame(rows, "path string, content string").repartition(3)
    found = {(r.doc_key, r.frag_idx): r.text for r in readers.code_tree_fragments(files).collect()}
    marks = [next(m for m in ("first0", "second0", "first1", "second1", "second2") if f"{m} =" in found["t/a.py", i]) for i in range(5)]
    assert marks == ["first0", "second0", "first1", "second1", "second2"]
    assert len(found) == 7 and ("t/b.py", 1) in found
