import hashlib
import json

import pytest

from pyspark.sql import types as T

from tracewright.operators import entities
from tracewright.sources import files


def test_collections(spark, tmp_path):
    body = {"profile": "m", "releaseId": "r1", "recordType": "course", "recordCount": 2, "records": [{"id": "a", "n": 1}, {"id": "b", "n": None}]}
    (tmp_path / "c.json").write_text(json.dumps(body, indent=2))
    record = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    rows = files.read_collection(spark, str(tmp_path / "c.json"), record).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("m", "r1", "course", 2, "a", 1), ("m", "r1", "course", 2, "b", None)]


def test_inventory(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "skip").mkdir()
    bodies = {"x/a.pdf": b"%PDF-1.7 body", "x/b.txt": b"text", "skip/c.pdf": b"nope"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    found = files.scan_files(files.binary_files(spark, str(tmp_path)), ["pdf", "txt"], ["skip"])
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.file_inventory(found).collect()}
    assert set(rows) == {"a.pdf", "b.txt"} and rows["a.pdf"]["sha256"] == hashlib.sha256(bodies["x/a.pdf"]).hexdigest()
    assert [r["path"].rsplit("/", 1)[1] for r in found.filter(files.magic_is(b"%PDF-")).collect()] == ["a.pdf"]
    catalog = files.file_inventory(found).selectExpr("path", "1 AS annex")
    got = files.receipts(files.file_inventory(found), catalog)
    assert files.total_bytes(got).first().asDict() == {"total_bytes": 17, "files": 2}
    assert entities.source_manifest(catalog, files.file_inventory(found).limit(1), "path").filter("received").count() == 1


def test_release(spark, tmp_path):
    counts = files.write_release({"t": spark.range(5).selectExpr("id", "id % 2 AS profile"), "u": spark.range(3)}, "r9", str(tmp_path), "profile")
    assert sorted(tuple(r) for r in counts.collect()) == [("r9", "t", 5), ("r9", "u", 3)]
    assert (tmp_path / "t" / "profile=1").is_dir()
    assert files.forbid_dataset(spark, str(tmp_path / "gone")) and not files.forbid_dataset(spark, str(tmp_path / "u"))


def test_a_killed_publication_leaves_the_old_release_whole(spark, tmp_path):
    root, made = str(tmp_path / "root"), []

    def built(n, fail=False):
        def broken(batches):
            raise RuntimeError("killed")
            yield from batches

        first, second = spark.range(n), spark.range(2 * n)
        return {"a": first, "b": second.mapInPandas(broken, "id long") if fail else second}

    assert files.current_release(spark, root) is None
    manifest = files.publish_release(built(3), "r1", root)
    assert sorted((r["release_id"], r["dataset"], r["n"]) for r in manifest.collect()) == [("r1", "a", 3), ("r1", "b", 6)]
    with pytest.raises(Exception, match="killed"):
        files.publish_release(built(50, fail=True), "r2", root)
    old = files.read_release(spark, root, ["a", "b"])
    assert files.current_release(spark, root) == "r1" and (old["a"].count(), old["b"].count()) == (3, 6)
    # the call is repeated: the table that was whole isn't written again
    made = sorted(p.name for p in (tmp_path / "root/staging/r2/a").iterdir())
    files.publish_release(built(50), "r2", root)
    assert sorted(p.name for p in (tmp_path / "root/releases/r2/a").iterdir()) == made
    now = files.read_release(spark, root, ["a", "b"])
    assert files.current_release(spark, root) == "r2" and (now["a"].count(), now["b"].count()) == (50, 100)
    assert old["b"].count() == 6 and files.read_release(spark, root, ["a"], "r1")["a"].count() == 3
    with pytest.raises(FileExistsError):
        files.publish_release(built(1), "r2", root)
    files.make_current(spark, root, "r1")
    assert files.current_release(spark, root) == "r1"


def test_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path)).collect()] == [("a.txt", "one\ntwo")]
