import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.sources.documents import read_json_documents, upsert, with_ids
from docquarry.streaming.ingest import append_changes, standing_query


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_json_lines_with_ids_from_folders(spark, tmp_path):
    for name, objects in (("key=a", [{"n": 1}, {"n": 2}]), ("key=b.c", [{"n": 3}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text("\n".join(map(json.dumps, objects)))
    found = read_json_documents(spark, str(tmp_path), lines=True, id_from="folder")
    assert rows(found, "_id", "n") == [("a", 1), ("a", 2), ("b.c", 3)]


def test_json_documents(spark, tmp_path):
    for name, version in (("42", 1), ("43", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"text": f"Document {name}", "version": version}, indent=1))
    assert rows(read_json_documents(spark, str(tmp_path)), "_id", "version") == [("42", 1), ("43", 2)]


def test_ids_are_generated_where_missing(spark):
    docs = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "_id string, v int")
    found = [r["_id"] for r in with_ids(docs).collect()]
    assert "a" in found and None not in found and len(set(found)) == 3


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    new = spark.createDataFrame(
        [("b", 3, 1, "x"), ("b", 4, 2, None), ("c", 5, None, "z")], "_id string, v int, seq int, extra string"
    )
    found = upsert(old, new, "_id", "seq")
    assert sorted(map(tuple, found.select("_id", "v", "extra").collect())) == [("a", 1, None), ("b", 4, None), ("c", 5, "z")]


def test_upsert_without_order_keeps_one(spark):
    old = spark.createDataFrame([("a", 1)], "_id string, v int")
    new = spark.createDataFrame([("b", 3), ("b", 4), ("a", 5), ("a", 5)], "_id string, v int")
    found = sorted(map(tuple, upsert(old, new).collect()))
    assert [r[0] for r in found] == ["a", "b"] and found[0] == ("a", 5)
    assert sorted(map(tuple, upsert(old, new.repartition(3)).collect())) == found


def write_batch(spark, folder, name, values):
    spark.createDataFrame(values, "_id string, v int, seq long").coalesce(1).write.parquet(f"{folder}/{name}")


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def test_stream_of_changes_resumes(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "changes")
    base = spark.createDataFrame([("a", 0), ("x", 9)], "_id string, v int")

    def load():
        reader = spark.readStream.schema("_id string, v int, seq long").option("recursiveFileLookup", True)
        run(append_changes(reader.option("maxFilesPerTrigger", 1).parquet(source), path, str(tmp_path / "cp")))
        return rows(upsert(base, spark.read.parquet(path), "_id", "seq"), "_id", "v")

    write_batch(spark, source, "one", [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)])
    assert load() == [("a", 2), ("b", 1), ("x", 9)]
    write_batch(spark, source, "two", [("b", 7, 5)])
    assert load() == [("a", 2), ("b", 7), ("x", 9)]
    assert spark.read.parquet(path).count() == 4


def test_streams_read_a_table_that_is_a_folder(spark, tmp_path):
    from docquarry.catalog.loading import _stream

    for folder, files in (("one", 1), ("many", 3)):
        df = spark.range(10).repartition(files)
        if files > 1:
            df.write.parquet(str(tmp_path / folder / "numbers.parquet"))
        else:
            (tmp_path / folder).mkdir()
            df.toPandas().to_parquet(tmp_path / folder / "numbers.parquet")
        out = str(tmp_path / folder / "out")
        stream = _stream(spark, str(tmp_path / folder), "numbers")
        run(append_changes(stream, out, str(tmp_path / folder / "cp")))
        assert spark.read.parquet(out).count() == 10


def test_standing_query(spark, tmp_path):
    source = str(tmp_path / "in")
    write_batch(spark, source, "one", [("a", 1, 1), ("b", 5, 1)])
    stream = spark.readStream.schema("_id string, v int, seq long").option("recursiveFileLookup", True).parquet(source)
    found = standing_query(stream, q.Bool.of(filter=[q.Range("v", gt=2)], must_not=[q.Term("_id", "z")]))
    run(found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).select(F.col("_id")).collect() == [Row(_id="b")]
