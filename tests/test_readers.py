"""CSV readers on drifting headers and torn lines; all-or-nothing batches; names of a model's inputs."""

from pyspark.sql import functions as F

from staffrank.operators import contract as B
from staffrank.sources import tables as TB


def write(path, name, lines):
    (path / name).write_text("\n".join(lines) + "\n")


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    assert TB.REQUIRED["users"] == ["location_id", "is_strict_location", "id", "has_mk"]
    torn = ["x,yes,1,0", "y,no,2", "z,maybe,3,1,9"]
    write(tmp_path, "a.csv", [",".join(TB.REQUIRED["users"]), *torn])
    write(tmp_path, "b.csv", ["note,has_mk,id,location_id", "n,TRUE,4,w", '"a, b",1,5,"q,r"'])
    write(tmp_path, "c.csv", [",".join(TB.REQUIRED["users"])])
    r = TB.read_checked(spark, str(tmp_path), "users")
    rows = {x.id: (x.location_id, x.is_strict_location, x.has_mk) for x in r.rows.collect()}
    assert rows == {"1": ("x", True, False), "4": ("w", None, True), "5": ("q,r", None, True)}
    assert sorted(x.line for x in r.rejected.collect()) == ["y,no,2", "z,maybe,3,1,9"]
    (d,) = r.drift.collect()
    assert d.file.endswith("b.csv") and (d.missing, d.extra, d.moved) == (["is_strict_location"], ["note"], True)
    assert r.rows.schema == TB.coerce_users(spark.createDataFrame([], "id string, location_id string, is_strict_location string, has_mk string")).schema


def test_a_folder_without_a_header_has_no_rows(spark, tmp_path):
    write(tmp_path, "a.csv", ["1,x,yes,0"])
    r = TB.read_checked(spark, str(tmp_path), "users")
    assert r.rows.count() == r.rejected.count() == r.drift.count() == 0


def test_a_batch_is_stored_whole_or_not_at_all(spark, tmp_path):
    target = f"file://{tmp_path}/users"
    rows = lambda *ids: spark.createDataFrame([(i, "l", True, False) for i in ids], "id string, location_id string, is_strict_location boolean, has_mk boolean")
    assert B.commit_batch(rows("a", "b"), "users", target, "1") == {"batch": "1", "rows": 2, "bad_rows": 0, "stored": True}
    assert not B.commit_batch(rows("c", ""), "users", target, "2")["stored"]
    stored = lambda: sorted(r.id for r in spark.read.parquet(target).collect())
    assert stored() == ["a", "b"]
    lost = spark.read.parquet(f"{target}-rejected")
    assert {(r.id, tuple(r.violations)) for r in lost.collect()} == {("c", ()), ("", ("id_nonempty",))}
    assert B.commit_batch(rows("c", "d"), "users", target, "2")["stored"]  # sent again, mended
    assert stored() == ["a", "b", "c", "d"]
    B.commit_batch(rows("a", "b"), "users", target, "1")
    assert stored() == ["a", "b", "c", "d"]


def test_a_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = spark.range(20).select(F.col("id").cast("string"), F.lit("l").alias("location_id"), F.lit(True).alias("is_strict_location"), F.lit(True).alias("has_mk"))
    B.commit_batch(rows.mapInPandas(counted, rows.schema), "users", f"file://{tmp_path}/u", "1")
    assert seen.value == 20
