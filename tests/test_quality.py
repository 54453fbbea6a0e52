import datetime
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidewright import session
from tidewright.operators import drift, packed
from tidewright.operators import profile as prof

EMPTY = "row_id long, load_no int, Email string, Website string, Contact_Name string, extra string"


def test_forms(spark):
    cases = {
        "Email": (["a.b+c@x-y.example", " a@b.de "], ["müller@x.de", "a@@b.de", "a..b@c.de", "a@b", "a@-b.de", "x"]),
        "Website": (["foo.de", "HTTPS://Foo.example.org:8080/a?b=1", "http://a.bc/?x"], ["http://localhost", "htp://a.de", "a.de, b.de", "https://https://a.de", "a . de"]),
        "Contact_Name": (["Anna Berg", "Łucja"], ["X", "12", "Anna 2", "a@b.de", "www.foo.example", "Anna\nBerg"]),
    }
    for column, (good, bad) in cases.items():
        df = spark.createDataFrame([(x,) for x in good + bad], "v string")
        got = [r[0] for r in df.select(prof.CONTACT_FORMS[column](F.col("v"))).collect()]
        assert got == [True] * len(good) + [False] * len(bad), column


def test_very_long_cells_do_not_fail(spark):
    df = spark.createDataFrame([("a." * 100_000 + "de",), ("x" * 300_000,), ("@" * 100_000,)], "v string")
    for form in prof.CONTACT_FORMS.values():
        assert df.where(form(F.col("v"))).count() <= 3
    cells = packed.cells_of(df.withColumn("k", F.lit(1)), "t", "k", ["v"])
    assert packed.split_packed(cells).count() >= 3


def test_profile_and_shifts(spark):
    rows = [(i, 1, "a@b.de", None, "Anna", "z") for i in range(8)] + [(9, 1, "bad", None, "Anna", "z"), (10, 1, None, None, "Anna", "z")]
    rows += [(20 + i, 2, "a@b.de" if i > 2 else None, None, f"Anna {chr(65 + i)}", "z") for i in range(10)]
    df = spark.createDataFrame(rows, EMPTY)
    p = {(r.column_name, r.load_no): r for r in prof.profile(df, "load_no", prof.CONTACT_FORMS).collect()}
    one = p["Email", 1]
    assert (one.n_rows, one.n_missing, one.n_pattern, one.n_distinct, one.n_top, int(one.sum_len_1)) == (10, 1, 1, 2, 8, 51)
    assert p["Website", 1].n_missing == 10 and p["Website", 1].min_value is None
    found = {tuple(r) for r in prof.shifts(prof.profile(df, "load_no", prof.CONTACT_FORMS), "load_no").collect()}
    assert found == {("Email", 2), ("Contact_Name", 2)}  # 0.1 to 0.3 missing is exactly 0.2
    empty = spark.createDataFrame([], EMPTY)
    assert prof.profile(empty, "load_no", prof.CONTACT_FORMS).count() == 0
    merged = prof.merge_profiles(prof.profile(df.where("row_id < 5"), "load_no", prof.CONTACT_FORMS).unionByName(prof.profile(df.where("row_id >= 5"), "load_no", prof.CONTACT_FORMS)), "load_no")
    whole = {(r.column_name, r.load_no): (r.n_rows, r.sum_len_4) for r in prof.profile(df, "load_no", prof.CONTACT_FORMS).collect()}
    assert {(r.column_name, r.load_no): (r.n_rows, r.sum_len_4) for r in merged.collect()} == whole


def test_packed_cells(spark):
    cases = {
        "a@x.de;b@y.de": ["a@x.de", "b@y.de"],
        "  a@x.de ; ; b@y.de ;": ["a@x.de", "b@y.de"],
        '"a@x.de" und b@y.de': ["a@x.de", "b@y.de"],
        "a@x.de b@y.de": ["a@x.de", "b@y.de"],
        "Berg, Anna | 030 123456": ["Berg, Anna", "030 123456"],
        "https://a.de/liste?a=1,2": ["https://a.de/liste?a=1,2"],
        "https://a.de, www.b.de,": ["https://a.de", "www.b.de"],
        '"0221 4710594, ab 10 Uhr" / 040 66 96 95': ["0221 4710594, ab 10 Uhr", "040 66 96 95"],
        '"Projekt ""Neu"" extern"\n\'069/900092\'': ['Projekt "Neu" extern', "069/900092"],
        "c/o Empfang || x@y.de": ["c/o Empfang", "x@y.de"],
        "030/23125 u. 040/66 oder 089 1": ["030/23125", "040/66", "089 1"],
        "a@x.de;a@x.de": ["a@x.de", "a@x.de"],
        '"broken; b@y.de': ['"broken', "b@y.de"],
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)] + [(99, None), (98, "  ")], "k long, v string")
    got: dict[int, list] = {}
    for r in packed.split_packed(packed.cells_of(df, "t", "k", ["v"])).orderBy("pos").collect():
        got.setdefault(r.row_key, []).append(r.item)
    assert [got.get(i) for i in range(len(cases))] == list(cases.values())
    assert 99 not in got and 98 not in got
    several = {r.row_key for r in packed.several(packed.cells_of(df, "t", "k", ["v"])).collect()}
    assert several == {i for i, x in enumerate(cases.values()) if len(x) > 1}
    assert packed.several(packed.cells_of(df.limit(0), "t", "k", ["v"])).count() == 0


def test_drift(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [
        (1, "f", 1, at, "2", '{"Mail": "a@x", "N": 1, "Old": "q", "Gone": null}'), (2, "f", 1, at, "3", '{"Mail": "b@x", "N": 2, "Old": "r"}'),
        (3, "f", 3, at, "2", '{"MAIL": "a@x", "N": "1", "New": 5}'), (4, "f", 3, at, "3", '{"N": "2", "MAIL": "b@x", "New": 6}'), (5, "f", 3, at, "3", '{"N": "2", "MAIL": "b@x", "New": 6}'),
        (6, "f", 3, at, "9", "no json"), (7, "f", 3, at, "10", None), (8, "g", 1, at, "2", '{"a": []}'),
    ]
    df = spark.createDataFrame(rows, "record_id long, Source_File string, load_no int, loaded_at timestamp, Source_Row string, payload string")
    cell = drift.cells(df)
    got = {tuple(r) for r in drift.changes(cell).collect()}
    assert got == {("f", 3, "renamed", "Mail", "MAIL"), ("f", 3, "type_changed", "N", "N"), ("f", 3, "removed", "Old", ""), ("f", 3, "removed", "Gone", ""), ("f", 3, "added", "", "New")}
    newest = {(r.load_no, r.field): r.newest for r in drift.newest_names(drift.versions(cell), drift.changes(cell)).collect() if r.source_file == "f"}
    assert newest[1, "Mail"] == "MAIL" and newest[3, "MAIL"] == "MAIL"
    assert {r.n_unreadable for r in drift.unreadable(df).where("load_no = 3").collect()} == {2}
    staging = spark.createDataFrame([("f", "2", "a@x", None), ("f", "3", "b@x", "q")], "Source_File string, Source_Row string, Email string, Notes string")
    out = {r.record_id: r for r in drift.consolidate(df, staging, ["Email", "Notes"]).collect()}
    assert out[1].Email == "a@x" and out[3].Email == "a@x" and '"New"' in out[3].extra and out[6].Email is None and len(out) == 8
    assert drift.changes(drift.cells(df.limit(0))).count() == 0


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = Context()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        session.ensure_checkpoint_dir(Session())


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower() or "ResolvedHint" in d._jdf.queryExecution().logical().toString()
    assert hinted(session.broadcast_if_small(df)) and not hinted(session.broadcast_if_small(df, size=10_000)) and not hinted(session.broadcast_if_small(df, limit=10))


def test_a_broken_import_is_seen(tmp_path):
    shutil.copytree("tidewright", tmp_path / "tidewright", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy("__spark_entry__.py", tmp_path)
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=False)
    shutil.rmtree(tmp_path / "tidewright" / "llm", ignore_errors=True)
    assert run().returncode == 0
    (tmp_path / "tidewright" / "llm").mkdir()
    (tmp_path / "tidewright" / "llm" / "__init__.py").write_text("")
    (tmp_path / "tidewright" / "llm" / "plans.py").write_text("import no_such_module\n")
    assert "no_such_module" in run().stderr
