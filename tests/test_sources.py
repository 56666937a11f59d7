import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap.queries.sources import page_lines
from corpusmap.queries.streams import pack_archives
from corpusmap.sources import archives, articles, catalogue, columnar, structured
from corpusmap.sources.archives import read_archives


def pack(path, *members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members:
            info = tarfile.TarInfo(name)
            if text is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                data = text.encode("utf-8")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))


LINES = [
    {"identifier": 1, "name": "One", "url": "u1", "abstract": "first ümlaut"},
    {"id": 2, "name": "Two", "url": "u2", "abstract": None},
    {"identifier": 3, "id": 99, "name": "Three"},
]


def ndjson(rows):
    return "".join(json.dumps(r) + "\n" for r in rows)


@pytest.fixture
def landed(tmp_path):
    pack(tmp_path / "enwiki_namespace_0" / "chunk_0.tar.gz", ("a.ndjson", ndjson(LINES)), ("b.ndjson", ndjson([{"id": 7}])))
    many = [{"id": 1000 + i, "name": f"Page {i}"} for i in range(9000)]
    pack(tmp_path / "dewiki_namespace_0" / "chunk_1.tar.gz", ("c.ndjson", ndjson(many)))
    return tmp_path


def test_first_member(spark, landed):
    lines = read_archives(spark, str(landed))
    assert lines.rdd.getNumPartitions() == 2
    pages = {r["page_id"]: r for r in articles.pages_from_lines(lines).collect()}
    assert len(pages) == 9003 and 7 not in pages and 99 not in pages
    assert pages[1]["abstract"] == "first ümlaut" and pages[1]["chunk_name"] == "chunk_0"
    assert pages[2]["abstract"] is None and pages[3]["title"] == "Three"
    assert pages[9999]["namespace"] == "dewiki_namespace_0" and pages[9999]["line_no"] == 9000


def test_all_members(spark, landed):
    lines = read_archives(spark, str(landed), members="all")
    assert {r["member"]: r["count"] for r in lines.groupBy("member").count().collect()} == {
        "a.ndjson": 3, "b.ndjson": 1, "c.ndjson": 9000
    }


def test_bad_archives(spark, tmp_path):
    pack(tmp_path / "empty" / "x.tar.gz")
    pack(tmp_path / "folder" / "x.tar.gz", ("d", None), ("a", "{}\n"))
    with pytest.raises(Exception, match="is empty"):
        read_archives(spark, str(tmp_path / "empty")).collect()
    with pytest.raises(Exception, match="not a regular file"):
        read_archives(spark, str(tmp_path / "folder")).collect()
    assert read_archives(spark, str(tmp_path / "folder"), members="all").count() == 1
    with pytest.raises(Exception, match="no such archive"):
        read_archives(spark, str(tmp_path / "missing.tar.gz")).collect()


def lines_of(spark, *texts):
    rows = [("enwiki_namespace_0", "c", i, t) for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, "namespace string, chunk_name string, line_no bigint, line string")


def test_bad_lines(spark):
    lines = lines_of(spark, '{"id": 1}', '{"name": "no id"}', "{broken", "")
    with pytest.raises(Exception, match="no page id"):
        articles.pages_from_lines(lines.filter("line_no <= 2")).collect()
    for unrelated in (lambda df: df.count(), lambda df: df.select("title").collect()):
        with pytest.raises(Exception, match="no page id"):
            unrelated(articles.pages_from_lines(lines.filter("line_no <= 2")))
    assert [r["page_id"] for r in articles.pages_from_lines(lines, "permissive").collect()] == [1]
    assert {r["line_no"]: r["error"].split()[0] for r in articles.rejected_lines(lines).collect()} == {2: "no", 3: "not", 4: "not"}


def test_article_dates_and_lists(spark):
    row = articles.parse_articles(spark.createDataFrame(
        [('{"identifier": 5, "date_created": "2024-02-03T04:05:06Z", "categories": null, '
          '"main_entity": {"identifier": "Q1", "url": "u", "aspects": ["a"]}}',)], "line string"
    ))
    first = row.first()
    assert str(first["date_created"]) == "2024-02-03 04:05:06"
    assert first["categories"] == [] and first["license"] == [] and first["version"] is None
    assert first["main_entity"]["aspects"] == ["a"]
    written = json.loads(articles.article_lines(row).first()["line"])
    assert written["date_created"] == "2024-02-03T04:05:06Z" and written["main_entity"]["identifier"] == "Q1"
    assert written["version"] is None and written["redirects"] == []
    with pytest.raises(Exception):
        articles.parse_articles(spark.createDataFrame([('{"date_created": "3 February"}',)], "line string")).collect()


def test_parts_and_tables_nest_without_a_bound(spark):
    part, cell = {"name": "x", "hasParts": []}, {"value": "v"}
    for _ in range(10):
        part = {"name": "x", "hasParts": [part]}
        cell = {"value": "v", "nested_table": {"identifier": "t", "rows": [[cell]]}}
    line = json.dumps({"infoboxes": [part], "tables": [{"identifier": "t", "rows": [[cell]]}]})
    contents = structured.parse_contents(spark.createDataFrame([(1, line), (2, "{}")], "page_id int, line string"), ["page_id"])
    parts = structured.flatten_parts(contents, ["page_id"])
    assert parts.count() == 11 and sorted(r["path"] for r in parts.collect()) == sorted("0" + ".0" * k for k in range(11))
    assert structured.flatten_tables(contents, ["page_id"]).select("value").count() == 11


def test_broken_json_is_no_article(spark):
    lines = spark.createDataFrame([('{"identifier": 5}',), ("{broken",), ("[1]",)], "line string")
    for parse in (articles.parse_articles, lambda x, *m: catalogue.parse_catalogue(x, "codes", *m), structured.parse_structured):
        with pytest.raises(Exception, match="not a JSON object"):
            parse(lines).count()
        assert parse(lines, "permissive").count() == 1
    assert articles.rejected_articles(lines).count() == catalogue.rejected_catalogue(lines, "codes").count() == 2


def test_catalogue_kinds(spark, tmp_path):
    (tmp_path / "codes").mkdir()
    (tmp_path / "codes" / "a.json").write_text('{"identifier": "wiki", "name": "n", "description": "d"}\n')
    codes = catalogue.read_catalogue(spark, "codes", str(tmp_path / "codes"))
    assert catalogue.by_identifier(codes, "wiki").first()["description"] == "d"
    with pytest.raises(ValueError):
        catalogue.read_catalogue(spark, "nothing", str(tmp_path))


def test_three_d_text(spark):
    df = spark.createDataFrame([("[1, 2.5, -3]",), (None,), ("",)], "t string")
    got = [r["v"] for r in df.select(columnar.vector_from_text(F.col("t")).alias("v")).collect()]
    assert got == [[1.0, 2.5, -3.0], None, None]
    for bad in ("[1, 2]", "[1, null, 2]", "{}", "[1,2,3,4]"):
        with pytest.raises(Exception, match="not a 3-d vector"):
            spark.createDataFrame([(bad,)], "t string").select(columnar.vector_from_text(F.col("t"))).collect()


def test_blobs(spark):
    vectors = np.random.default_rng(0).standard_normal((50, 7)).astype("<f4")
    rows = [(i, bytearray(v.tobytes()) if i % 4 else None) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "i int, b binary").repartition(3)
    for row in df.select("i", columnar.floats_from_blob("b").alias("v")).collect():
        assert row["v"] is None if row["i"] % 4 == 0 else np.array_equal(np.float32(row["v"]), vectors[row["i"]])
    with pytest.raises(Exception, match="whole number of float32"):
        spark.createDataFrame([(bytearray(b"12345"),)], "b binary").select(columnar.floats_from_blob("b")).collect()


def test_write_table_spreads_a_hot_namespace(spark, tmp_path):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("ns"), F.col("id") % 5)).alias("namespace"),
        F.col("id").alias("page_id"),
    )
    columnar.write_table(df, str(tmp_path / "t"), "page_id")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000
    assert (tmp_path / "t" / "namespace=hot").is_dir()


def test_bucketed_tables_join_without_a_shuffle(spark):
    pages = spark.range(2000).select(F.lit("n").alias("namespace"), F.col("id").alias("page_id"), F.lit("t").alias("title"))
    columnar.save_bucketed(pages, "bucketed_pages", 4)
    columnar.save_bucketed(pages.select("namespace", "page_id").filter("page_id % 2 = 0"), "bucketed_vectors", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_pages").join(spark.table("bucketed_vectors"), ["namespace", "page_id"], "left_anti")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE bucketed_pages")
        spark.sql("DROP TABLE bucketed_vectors")


def test_convert_all_tables(spark, sf_dir, tmp_path):
    from corpusmap import fixtures as fx

    vectors = fx.page_vector(spark, sf_dir)
    nodes = fx.cluster_tree(spark, sf_dir)
    columnar.convert({
        "chunk_log": fx.chunk_log(spark, sf_dir),
        "page_log": fx.page_log(spark, sf_dir),
        "page_vector": vectors.withColumns({
            "embedding_vector": columnar.blob_from_floats("embedding_vector"),
            "reduced_vector": columnar.blob_from_floats("reduced_vector"),
            "three_d_vector": columnar.text_from_vector(F.col("three_d_vector")),
        }),
        "cluster_tree": nodes.withColumns({
            "centroid": F.lit(None).cast("binary"), "top_terms": F.lit('["a","b"]'), "sample_doc_ids": F.lit("[3,1]"),
        }),
    }, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "page_vector")).select(vectors.columns)
    assert back.exceptAll(vectors).isEmpty() and back.count() == vectors.count()
    tree = spark.read.parquet(str(tmp_path / "cluster_tree"))
    assert tree.filter("top_terms[1] = 'b' and sample_doc_ids[0] = 3").count() == nodes.count()
    assert spark.read.parquet(str(tmp_path / "page_log")).count() == 200


def test_batches_of_an_hour(spark, tmp_path):
    import datetime

    folder = tmp_path / "batches" / "2024-01-05" / "07"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"identifier": "b1", "dateModified": "2024-01-05T07:10:00Z", "size": {"value": 2.5}}\n')
    time = datetime.datetime(2024, 1, 5, 7, 59)
    row = catalogue.read_batches_of_hour(spark, str(tmp_path), time).first()
    assert row["identifier"] == "b1" and row["size"]["value"] == 2.5
    prefix = spark.range(1).select(catalogue.batch_prefix(F.lit(time)).alias("p")).first()["p"]
    assert prefix == "batches/2024-01-05/07"


def test_images_of_parts(spark):
    part = {"name": "x", "images": [{"contentUrl": "i", "width": 3}], "links": [{"url": "u", "images": [{"contentUrl": "j"}]}]}
    df = spark.createDataFrame([(1, json.dumps({"articleSections": [part, {"name": "y"}]}))], "page_id int, line string")
    parts = structured.flatten_parts(structured.parse_contents(df, ["page_id"]), ["page_id"])
    assert parts.count() == 2
    image = structured.part_images(parts, ["page_id"]).first()
    assert (image["path"], image["contentUrl"], image["width"]) == ("0", "i", 3)
    assert structured.part_links(parts, ["page_id"]).first()["images"][0]["contentUrl"] == "j"


def test_articles_written_and_read_back(spark, tmp_path):
    line = ('{"identifier": 5, "name": "N", "date_modified": "2024-02-03T04:05:06Z", "license": [{"name": "L"}], '
            '"version": {"identifier": 9, "tags": ["t"], "scores": {"revert_risk": {"prediction": true, "probability": {"false": 0.25, "true": 0.75}}}}}')
    rows = articles.parse_articles(spark.createDataFrame([(line,)], "line string"))
    articles.write_articles(rows, str(tmp_path / "out"))
    back = articles.read_articles(spark, str(tmp_path / "out"))
    assert back.first() == rows.first()
    assert back.first()["version"]["scores"]["revert_risk"]["probability"]["false"] == 0.25


def test_only_the_archives_asked_for_are_opened(spark, sf_dir, tmp_path):
    pack_archives(page_lines(spark, sf_dir), str(tmp_path))
    lines = archives.read_archives(spark, str(tmp_path))
    rows = lines.groupBy("namespace", "chunk_name").count().collect()
    names = sorted({r.namespace for r in rows})
    some = archives.read_archives(spark, str(tmp_path), namespaces=names[:2])
    assert some.rdd.getNumPartitions() == sum(len(list((tmp_path / n).glob("*.tar.gz"))) for n in names[:2]) < lines.rdd.getNumPartitions()
    assert some.count() == sum(r["count"] for r in rows if r.namespace in names[:2])
    one = archives.read_archives(spark, str(tmp_path), namespaces={rows[0].namespace}, chunks={rows[0].chunk_name})
    assert one.rdd.getNumPartitions() == 1 and one.count() == rows[0]["count"]
    assert archives.read_archives(spark, str(tmp_path), namespaces=()).count() == 0


def test_broken_lines_of_a_listing(spark, tmp_path):
    (tmp_path / "batches").mkdir()
    (tmp_path / "batches" / "a.json").write_text('{"identifier": "one", "version": "1"}\n\n{broken\n[3]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        catalogue.read_catalogue(spark, "batches", str(tmp_path / "batches")).collect()
    good = catalogue.read_catalogue(spark, "batches", str(tmp_path / "batches"), "permissive")
    assert [r.identifier for r in good.collect()] == ["one"]
    bad = catalogue.rejected_catalogue(catalogue.catalogue_lines(spark, str(tmp_path / "batches")), "batches")
    assert sorted(r.line for r in bad.collect()) == ["[3]", "{broken"]


def test_page_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("n", "c", 1, '{"identifier": 1, "name": "a"}')], "namespace string, chunk_name string, line_no long, line string")
    plan = articles.pages_from_lines(lines, "permissive")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
