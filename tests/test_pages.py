"""Sources, plug-ins, the whole page plan, the stream and the registered queries."""

import json
import math

import duckdb
import pytest

import __spark_entry__ as driver
from plotwright import catalogue
from plotwright.operators import folds, mapping
from plotwright.plans import page
from plotwright.sources import manifest, plugins
from plotwright.streaming.pages import finish_stream

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Reader:
    """A recogniser that reads its picture as lines of "text x y"."""

    def read(self, picture, scale):
        out = []
        for line in picture.decode().splitlines():
            t, x, y = line.rsplit(" ", 2)
            x, y = int(x) * scale, int(y) * scale
            out.append((t, [(x, y), (x + 40 * scale, y), (x + 40 * scale, y + 18 * scale), (x, y + 18 * scale)], 0.9))
        return out


class Press:
    def pages(self, content, dpi):
        return content.split(b"\f")


def tiles(spark):
    cols = "page_id long, tile_id long, scale double, content binary, font double, orig_x long, orig_y long, step_x long, step_y long, full_w long, full_h long"
    one, two = b"C11 100 100\nDS1 300 100\nhello 500 300", b"hello 100 300\n220 kV SIDE 700 500"
    return spark.createDataFrame([(1, 0, 1.0, bytearray(one), 20.0, 0, 0, 400, 800, 1200, 1000), (1, 1, 1.25, bytearray(two), 20.0, 400, 0, 400, 800, 1200, 1000)], cols)


def test_page_plan(spark):
    t = tiles(spark)
    found = plugins.recognise(t, Reader)
    final = page.page_items(found, t.drop("scale", "content"))
    rows = final.orderBy("seq").collect()
    assert sorted(r.text for r in rows) == ["220 kV SIDE", "C11", "DS1", "hello"]
    words = spark.createDataFrame([(1, 0, "extra", 10.0, 900.0, 50.0, 918.0), (1, 1, "hello", 500.0, 300.0, 540.0, 318.0)], "page_id long, word_id long, text string, x0 double, y0 double, x1 double, y1 double")
    merged = page.with_document_words(final, words)
    assert sorted(r.text for r in merged.collect()) == ["220 kV SIDE", "C11", "DS1", "extra", "hello"]
    pages = spark.createDataFrame([(1, "a/doc/page1.png"), (2, "a/doc/page2.png")], "page_id long, path string")
    out = {r.page_id: r for r in page.page_results(pages, final, merged).collect()}
    assert out[1].voltage_level == [110] and len(out[1].ocr) == 5 and out[2].ocr == [] and out[2].voltage_level == []


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    t = tiles(spark)
    plugins.recognise(t, Reader).write.parquet(str(tmp_path / "in"))
    finish_stream(spark, str(tmp_path / "in"), t.drop("scale", "content"), str(tmp_path / "out"), str(tmp_path / "mark"), files=100).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = page.page_items(plugins.recognise(t, Reader), t.drop("scale", "content"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rasterise(spark):
    df = spark.createDataFrame([("x.pdf", bytearray(b"one\ftwo"))], "path string, content binary")
    assert [(r.page_id, bytes(r.content)) for r in plugins.rasterise(df, Press).orderBy("page_id").collect()] == [(1, b"one"), (2, b"two")]


def test_manifests_words_and_sink(spark, tmp_path):
    for name, body in {"a": {"images": [{"id": 1, "path": "c/doc/page1.png"}]}, "b": {"images": None}, "c": {}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    rows = manifest.manifests(spark, *(str(tmp_path / f"{n}.json") for n in "abc"))
    assert [(r.page_id, r.path) for r in rows.collect()] == [(1, "c/doc/page1.png")]
    assert rows.select(manifest.document_of(rows["path"])).first()[0] == "doc"
    folder = tmp_path / "words" / "doc"
    folder.mkdir(parents=True)
    (folder / "doc_page3.pdf.json").write_text(json.dumps({"pdf_texts": [{"text": "x", "bbox": [1, 2, 3, 4]}, {"text": "y", "bbox": [5, 6, 7, 8]}], "pdf_size": [100, 200]}))
    words = manifest.page_words(spark, str(tmp_path / "words")).orderBy("word_id").collect()
    assert [(w.document, w.page_id, w.text, w.top, w.pdf_h) for w in words] == [("doc", 3, "x", 2.0, 200.0), ("doc", 3, "y", 6.0, 200.0)]
    manifest.write_results(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_missing_image_fails(spark, tmp_path):
    (tmp_path / "page1.png").write_bytes(b"x")
    pages = spark.createDataFrame([(1, str(tmp_path / "page1.png"))], "page_id long, path string")
    assert bytes(manifest.page_images(spark, pages, str(tmp_path)).first().content) == b"x"
    gone = spark.createDataFrame([(2, str(tmp_path / "page2.png"))], "page_id long, path string")
    with pytest.raises(Exception, match="no such image"):
        manifest.page_images(spark, gone, str(tmp_path)).collect()


def test_turned_back(spark):
    # A clockwise turn sends (x, y) to (height - y, x).
    df = spark.createDataFrame([(70, 10, 80, 30, 200, 100)], "x0 long, y0 long, x1 long, y1 long, full_w long, full_h long")
    assert mapping.turned_back(df).select("x0", "y0", "x1", "y1").first()[:] == (10, 20, 30, 30)


def plain_rows(rows):
    return sorted(repr([round(float(v), 6) if isinstance(v, float) and not math.isnan(v) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(driver.oracle_sql()[name])
    names = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(n) for n in names]
    got = driver.queries()[name](spark, SMALL)
    assert sorted(got.columns) == names
    assert plain_rows(got.select(*names).collect()) == plain_rows([[r[i] for i in order] for r in want.fetchall()])


def test_entry_and_folds_run(spark):
    assert driver.entry(spark).count() > 0
    for name in sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)):
        assert driver.queries()[name](spark, SMALL).count() > 0


def test_page_fold_is_the_plain_fold(spark):
    items = catalogue._items(spark, SMALL)
    got = catalogue.nms(spark, SMALL).where("page_id = 7").orderBy("seq").collect()
    own = items.where("page_id = 7").orderBy("l", "w", "k").toPandas()
    want = folds.suppress(folds.items_of(own))
    assert [(r.text, r.x0, r.confidence) for r in got] == [(i.text, float(i.box[0]), i.confidence) for i in want]
