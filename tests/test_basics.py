from pyspark.sql import functions as F

# Three people.
PEOPLE = [(1, "Alice", 25), (2, "Bob", 30), (3, "Charlie", 35)]


def test_literal_rows_filter_and_sort(spark):
    df = spark.createDataFrame(PEOPLE, ["ID", "Name", "Age"])
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "bigint"]
    assert [r["Name"] for r in df.filter(F.col("Age") > 28).orderBy("ID").collect()] == ["Bob", "Charlie"]
    assert [r["Name"] for r in df.select("Name", "Age").orderBy(F.col("Age").desc()).collect()] == [
        "Charlie", "Bob", "Alice"]


def test_site_rows_literal_schema(sites):
    # two literal rows, types inferred (longitude/latitude double, the rest string)
    types = {f.name: f.dataType.simpleString() for f in sites.schema.fields}
    assert types["longitude"] == "double" and types["last_sync"] == "string" and types["site_name"] == "string"
    assert sites.count() == 2
