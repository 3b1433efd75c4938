"""Readers, sinks, parsers and streams on files made here."""

import io
import json
import os
import sqlite3
import zipfile

import pytest

from palimpsest.operators.gates import GateError
from palimpsest.sources import containers, documents, markup, tabular
from palimpsest.streaming import feeds
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

FAILED = (PySparkException, Py4JJavaError)
SCHEMA = StructType([StructField("id", StringType()), StructField("n", IntegerType())])


def test_jsonl(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"id":"a","n":1}\n{"id":"b","n":null}\n')
    assert {r.id for r in tabular.read_jsonl(spark, str(good), SCHEMA, ["id"]).collect()} == {"a", "b"}
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id":"a","n":1}\nnot json\n{"id":"c","n":-5}\n{"id":"a","n":2}\n')
    with pytest.raises(FAILED):
        tabular.read_jsonl(spark, str(bad), SCHEMA).collect()
    rows, out = tabular.read_jsonl_quarantined(spark, str(bad), SCHEMA, F.col("n") > 0)
    assert rows.count() == 2 and {r.line for r in out.collect()} == {"not json", '{"id":"c","n":-5}'}
    double = tmp_path / "double.jsonl"
    double.write_text('{"id":"a","n":1}\n{"id":"a","n":2}\n')
    with pytest.raises(GateError):
        tabular.read_jsonl(spark, str(double), SCHEMA, ["id"])


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('﻿code,name\n1,"a, b"\n2,\n', encoding="utf-8")
    df = tabular.read_csv(spark, str(path), ["code", "name"], "code")
    assert [(r.code, r.name) for r in df.orderBy("code").collect()] == [("1", "a, b"), ("2", None)]
    assert [tuple(r) for r in tabular.profile(df, ["code", "name"]).orderBy("column").collect()] == [("code", 2, 2, 0), ("name", 2, 1, 1)]
    for content, error in (("code,title\n1,2\n", ValueError), ("code,name,x\n1,2,3\n", ValueError), ("code,name\n", ValueError), ("code,name\n,b\n", GateError), ("", ValueError)):
        path.write_text(content)
        with pytest.raises(error):
            tabular.read_csv(spark, str(path), ["code", "name"], "code")
    path.write_text("code,name\n1\n")
    with pytest.raises((*FAILED, ValueError, GateError)):
        tabular.read_csv(spark, str(path), ["code", "name"], "code").collect()


def test_sealed_runs_and_exports(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, True), ("a", 1, None)], "id string, n int, flag boolean")
    tabular.write_run(df, str(tmp_path), "t", "r1")
    with pytest.raises(FAILED):
        tabular.write_run(df, str(tmp_path), "t", "r1")
    manifest = tabular.seal(spark, str(tmp_path), ["t"], "r1")
    assert tabular.verify_seal(spark, str(tmp_path), manifest).isEmpty()
    assert not tabular.verify_seal(spark, str(tmp_path), manifest.withColumn("row_count", F.lit(9).cast("bigint"))).isEmpty()
    tabular.write_canonical_jsonl(df, str(tmp_path / "canonical"))
    lines = [line for f in sorted((tmp_path / "canonical").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines == ['{"flag":null,"id":"a","n":1}', '{"flag":true,"id":"b","n":2}']
    assert tabular.export_sqlite(df, "t", str(tmp_path / "t.db")) == 2
    with sqlite3.connect(tmp_path / "t.db") as db:
        assert sorted(db.execute("SELECT id, n, flag FROM t")) == [("a", 1, None), ("b", 2, 1)]
    with pytest.raises(ValueError):
        tabular.export_sqlite(df, "t", str(tmp_path / "u.db"), limit=1)
    tabular.write_documents(df, "id", "n", str(tmp_path / "docs"))
    docs = [json.loads(line) for f in (tmp_path / "docs").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(d["id"] for d in docs) == ["a", "b"]
    with pytest.raises(GateError):
        tabular.foreign_key_gate(df, df.where("n = 1").withColumnRenamed("id", "p"), "id", "p")


def test_validated_append(spark, tmp_path):
    path = str(tmp_path / "log")
    df = lambda *x: spark.createDataFrame(list(x), SCHEMA)
    assert tabular.append_jsonl(df(("a", 1), ("b", 2)), path, SCHEMA, F.col("n") > 0, ["id"]) == 2
    assert tabular.append_jsonl(df(("c", 3)), path, SCHEMA, F.col("n") > 0, ["id"]) == 1
    for bad in (df(("d", -1)), df(("d", None)), df(("d", 1), ("d", 2)), df(("a", 9))):
        with pytest.raises(GateError):
            tabular.append_jsonl(bad, path, SCHEMA, F.col("n") > 0, ["id"])
    with pytest.raises(ValueError):
        tabular.append_jsonl(df(("d", 1)).select("id"), path, SCHEMA, F.lit(True))
    assert sorted(r.id for r in tabular.read_jsonl(spark, path, SCHEMA, ["id"]).collect()) == ["a", "b", "c"]


def test_blobs_are_put_once(spark, tmp_path):
    root = f"file://{tmp_path}"
    name, new = tabular.put_blob(spark, root, b"content")
    assert new and tabular.put_blob(spark, root, b"content") == (name, False) and (tmp_path / name).read_bytes() == b"content"
    assert [r.blob_path for r in tabular.blobs(spark, str(tmp_path / "raw")).collect()] == [name]
    (tmp_path / name).write_bytes(b"other")
    (tmp_path / name).with_name(f".{name.rsplit('/', 1)[1]}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        tabular.put_blob(spark, root, b"content")


def test_stage_export(spark, tmp_path):
    tables = {"t": spark.createDataFrame([("b", 2), ("a", None)], "id string, n int"), "u": spark.createDataFrame([], "x string")}
    manifest = tabular.export_stage(tables, str(tmp_path), "r1")
    assert {(r.table_name, r.row_count) for r in manifest.collect()} == {("t", 2), ("u", 0)}
    with sqlite3.connect(tmp_path / "r1" / "snapshot.sqlite") as db:
        assert sorted(db.execute("SELECT id FROM t")) == [("a",), ("b",)]
    assert len([line for f in (tmp_path / "r1" / "manifest.jsonl").glob("part-*") for line in f.read_text().splitlines()]) == 2
    with pytest.raises(FAILED):
        tabular.export_stage(tables, str(tmp_path), "r1")


def test_blobs(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"one")
    files = tabular.blobs(spark, str(tmp_path))
    row = files.first()
    assert row.blob_path.endswith(row.sha256) and row.length == 3
    manifest = spark.createDataFrame([(row.sha256, 4), ("0" * 64, 1)], "sha256 string, byte_length long")
    assert {r.problem for r in tabular.verify_blobs(manifest, files).collect()} == {"length", "missing"}


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/a.pdf'>File&nbsp;A</a></li><li><a href="b.odt?x=1">B</a></li>
<li><a href='/a.pdf'>again</a></li><li><a href='page.html'>Page</a></li></ul></nav><script>no()</script>
<table><tr><th>發文字號：</th><td>審字第1號</td></tr><tr><th>日期</th><td>112/6/1</td></tr></table>
<table><tr><td><a href='page.html'>Page</a></td><td>x</td><td>y</td></tr></table><p>One<br>Two &amp; three</p></body></html>"""


def test_html(spark):
    assert [x["url"] for x in markup.attachment_links(PAGE, "https://ex.org/d/")] == ["https://ex.org/a.pdf", "https://ex.org/d/b.odt?x=1"]
    assert [(x["label"], x["value"]) for x in markup.label_values(PAGE)] == [("發文字號", "審字第1號"), ("日期", "112/6/1")]
    assert markup.single_label_table(PAGE) == {"發文字號": "審字第1號", "日期": "112/6/1"}
    with pytest.raises(ValueError):
        markup.single_label_table(PAGE + PAGE)
    assert [x["url"] for x in markup.listing_rows(PAGE, "https://ex.org/d/")] == ["https://ex.org/d/page.html"]
    shown = markup.visible_text(PAGE)
    assert "no()" not in shown and "One\nTwo & three" in shown
    assert markup.decode_page("é".encode("latin-1"), "text/html; charset=iso-8859-1") == "é" and markup.decode_page("é".encode(), None) == "é"
    df = spark.createDataFrame([(PAGE,), (None,)], "html string")
    got = df.select(markup.visible_text_of(F.col("html")).alias("t"), markup.label_values_of(F.col("html")).alias("p"), markup.attachment_links_of(F.col("html"), "https://ex.org").alias("l")).collect()
    assert got[0].t == shown and len(got[0].p) == 2 and len(got[0].l) == 2 and tuple(got[1]) == (None, None, None)


def test_listing_rows_keep_their_own_links():
    row = "<tr><td>{0}</td><td><a href='d{0}.html'>修正給付規定</a></td><td><a href='{0}.pdf'>PDF</a> <a href='{0}.odt'>ODT</a></td></tr>"
    page = "<a href='/home'>修正給付規定</a><table><tr><th>n</th><th>修正給付規定</th><th></th></tr>" + "".join(row.format(i) for i in range(20)) + "</table>"
    got = markup.listing_rows(page, "https://ex.org/")
    assert [(x["title"], x["url"], x["cells"]) for x in got] == [("修正給付規定", f"https://ex.org/d{i}.html", [str(i), "修正給付規定", "PDF ODT"]) for i in range(20)]
    assert [(x["column_index"], x["url"], x["label"]) for x in got[7]["links"]] == [(1, "https://ex.org/d7.html", "修正給付規定"), (2, "https://ex.org/7.pdf", "PDF"), (2, "https://ex.org/7.odt", "ODT")]
    (inner, outer) = markup.listing_rows("<table><tr><td><a href='o'>out</a><table><tr><td>see <a href='i'>in</a></td></tr></table></td></tr></table>", "https://ex.org/")
    assert (inner["title"], inner["url"], outer["title"], outer["url"]) == ("in", "https://ex.org/i", "out", "https://ex.org/o")


def test_listing_pages():
    row = "<tr><td><a href='d{0}.html'>公告{0}</a></td><td>x</td></tr>"
    made = lambda n, rows, after: f"<p>共 5 筆，第 {n} / 3 頁</p><table>{''.join(row.format(i) for i in rows)}</table>" + (f"<a href='?p={n + 1}'>下一頁</a>" if after else "")
    pages = [markup.listing_page(made(n, rows, n < 3), "https://ex.org/l") for n, rows in ((1, [1, 2]), (2, [3, 4]), (3, [5]))]
    assert [(p["page"], p["pages"], p["total"], p["next_url"]) for p in pages] == [(1, 3, 5, "https://ex.org/l?p=2"), (2, 3, 5, "https://ex.org/l?p=3"), (3, 3, 5, None)]
    assert markup.listing_problems(pages) == [] and markup.listing_problems([]) == []
    assert markup.listing_problems([pages[0], pages[2]]) == ["page_numbers", "pages_missing", "rows_missing"]
    assert markup.listing_problems([pages[0], {**pages[1], "rows": pages[0]["rows"]}, pages[2]]) == ["repeated_rows"]
    assert markup.listing_page("<p>Page 2 of 9, 81 results</p>", "https://ex.org/") == {"rows": [], "page": 2, "pages": 9, "total": 81, "next_url": None}


def test_rss(spark):
    item = "<item><guid>{0}</guid><title>t{0}</title><link>l</link><pubDate>d</pubDate></item>"
    feed = "<rss><channel>" + item.format(1) + item.format(2) + "</channel></rss>"
    df = spark.createDataFrame([("a", feed), ("b", feed.replace("<guid>2", "<guid>1")), ("c", '<!DOCTYPE x [<!ENTITY e "v">]><rss/>'), ("d", "<rss")], "f string, xml string")
    got = markup.feed_items(df, "xml").collect()
    assert sorted((r.f, r.guid) for r in got if r.guid) == [("a", "1"), ("a", "2")] and {r.f for r in got if r.feed_error} == {"b", "c", "d"}


def office(name, xml):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr(name, xml)
    return out.getvalue()


ODF = 'xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0" xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0"'


def test_office_documents(spark, tmp_path):
    odt = f'<office:document-content {ODF}><office:body><office:text><text:h text:outline-level="1">H</text:h><text:p>a<text:s text:c="2"/>b<text:line-break/>c</text:p><text:list><text:list-item><text:p>i</text:p></text:list-item></text:list><table:table><table:table-row><table:table-cell><text:p>x</text:p></table:table-cell></table:table-row></table:table></office:text></office:body></office:document-content>'
    ods = f'<office:document-content {ODF}><office:body><office:spreadsheet><table:table table:name="S"><table:table-row table:number-rows-repeated="2"><table:table-cell table:number-columns-repeated="2" office:value-type="float" office:value="1.50"><text:p>1.5</text:p></table:table-cell><table:covered-table-cell/></table:table-row><table:table-row table:number-rows-repeated="99999"><table:table-cell/></table:table-row></table:table></office:spreadsheet></office:body></office:document-content>'
    word = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = f"<w:document {word}><w:body><w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    assert [(b["block_kind"], b["container"], b["raw_text"]) for b in documents.odt_blocks(office("content.xml", odt))] == [("heading", "body", "H"), ("paragraph", "body", "a  b\nc"), ("paragraph", "list", "i"), ("paragraph", "table", "x")]
    cells = documents.ods_cells(office("content.xml", ods))
    assert [(c["row_index"], c["column_index"], c["raw_value"]) for c in cells] == [(0, 0, "1.50"), (0, 1, "1.50"), (1, 0, "1.50"), (1, 1, "1.50")]
    assert [(b["container"], b["place"], b["raw_text"]) for b in documents.docx_blocks(office("word/document.xml", docx))] == [("body", "", "a\tb"), ("table", "t0r0c0", "c")]
    (tmp_path / "a.odt").write_bytes(office("content.xml", odt))
    (tmp_path / "b.odt").write_bytes(b"no zip")
    got = documents.read_documents(tabular.blobs(spark, str(tmp_path), "*.odt"), documents.odt_blocks).collect()
    assert len([r for r in got if r.error is None]) == 4 and [r.path.endswith("b.odt") for r in got if r.error] == [True]


def test_nested_tables_come_once():
    cell = lambda *x: "<table:table-cell>" + "".join(x) + "</table:table-cell>"
    row = lambda *x: "<table:table-row>" + "".join(x) + "</table:table-row>"
    p = lambda t: f"<text:p>{t}</text:p>"
    inner = "<table:table>" + row(cell(p("inner"))) + "</table:table>"
    outer = "<table:table><table:table-header-rows>" + row(cell(p("head"))) + "</table:table-header-rows>" + row(cell(p("outer"), inner), cell(p("last"))) + "</table:table>"
    odt = f"<office:document-content {ODF}><office:body><office:text>{outer}</office:text></office:body></office:document-content>"
    got = [(b["raw_text"], b["place"]) for b in documents.odt_blocks(office("content.xml", odt))]
    assert got == [("head", "t0r0c0"), ("outer", "t0r1c0"), ("inner", "t0r1c0t1r0c0"), ("last", "t0r1c1")]
    sheet = '<table:table table:name="s">' + row(cell(p("a"), inner)) + row(cell(p("b"))) + "</table:table>"
    ods = f"<office:document-content {ODF}><office:body><office:spreadsheet>{sheet}</office:spreadsheet></office:body></office:document-content>"
    assert [(c["rendered_text"], c["row_index"]) for c in documents.ods_cells(office("content.xml", ods))] == [("a", 0), ("b", 1)]


def test_long_repeats_of_cells_are_kept(spark, tmp_path):
    row = '<table:table-row table:number-rows-repeated="{}"><table:table-cell/><table:table-cell table:number-columns-repeated="{}" office:value-type="string"><text:p>{}</text:p></table:table-cell></table:table-row>'
    ods = f'<office:document-content {ODF}><office:body><office:spreadsheet><table:table table:name="S">{row.format(5000, 2, "a")}{row.format(1, 1, "b")}</table:table></office:spreadsheet></office:body></office:document-content>'
    expected = [(r, c, "a") for r in range(5000) for c in (1, 2)] + [(5000, 1, "b")]
    assert [(c["row_index"], c["column_index"], c["rendered_text"]) for c in documents.ods_cells(office("content.xml", ods))] == expected
    (tmp_path / "a.ods").write_bytes(office("content.xml", ods))
    (tmp_path / "b.ods").write_bytes(b"no zip")
    got = documents.read_documents(tabular.blobs(spark, str(tmp_path), "*.ods"), documents.ods_cells)
    assert got.columns == ["path", "error", *[n for n, _ in documents.CELL_FIELDS]]
    rows = got.collect()
    assert sorted((r.row_index, r.column_index, r.rendered_text) for r in rows if r.error is None) == expected
    assert [(r.path.endswith("b.ods"), r.row_index) for r in rows if r.error] == [(True, None)]


def test_streamed_transitions_equal_the_batch(spark, tmp_path):
    source, sink = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    batches = [[("k", 1, "new"), ("j", 1, "done")], [("k", 2, "done"), ("k", 1, "new"), ("j", 2, "done")]]
    allowed = {(None, "new"), ("new", "done"), ("done", "done")}
    for i, batch in enumerate(batches):
        (source / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("key", "n", "s"), r))) for r in batch))
        os.utime(source / f"{i}.json", (1000 + i, 1000 + i))  # files are read by their age
    stream = spark.readStream.schema("key string, n long, s string").option("maxFilesPerTrigger", 1).json(str(source))
    out = feeds.checked_transitions(stream, "key", "n", "s", allowed)
    query = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(sink))
    query.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(sink)).select("key", "n", "to_state", "legal").collect())
    assert got == [("j", 1, "done", False), ("j", 2, "done", True), ("k", 1, "new", True), ("k", 2, "done", True)]


def test_streamed_items_are_seen_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, guids in enumerate((["a", "b"], ["b", "c"])):
        (source / f"{i}.json").write_text("\n".join(json.dumps({"guid": g, "seen": f"2024-01-0{i + 1}T00:00:00Z"}) for g in guids))
    stream = spark.readStream.schema("guid string, seen timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    query = feeds.new_items(stream, "guid", "seen").writeStream.format("memory").queryName("items").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(r.guid for r in spark.table("items").collect()) == ["a", "b", "c"]


def compound(streams):
    """A compound file with one small sector table: the streams lie in the mini stream."""
    import struct

    mini, table, entries = b"", [], []
    for name, body in streams.items():
        start, count = len(mini) // 64, max(1, -(-len(body) // 64))
        mini += body.ljust(count * 64, b"\0")
        table += [*range(start + 1, start + count), 0xFFFFFFFE]
        entries.append((name, 2, start, len(body)))
    sectors = -(-len(mini) // 512)
    entries.insert(0, ("Root Entry", 5, 3, len(mini)))
    directory = b""
    for name, kind, start, size in entries:
        raw = name.encode("utf-16-le") + b"\0\0"
        directory += raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw), kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<IQ", start, size)
    directory = directory.ljust(512, b"\0")
    fat = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE, *range(4, 3 + sectors), 0xFFFFFFFE]
    fat += [0xFFFFFFFF] * (128 - len(fat))
    header = bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 6
    header += struct.pack("<IIIIIIIII", 0, 1, 1, 0, 4096, 2, 1, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    minifat = struct.pack("<128I", *table, *[0xFFFFFFFF] * (128 - len(table)))
    return header + struct.pack("<128I", *fat) + directory[:512] + minifat + mini.ljust(sectors * 512, b"\0")


def test_containers(spark):
    from palimpsest.functions.text import media_type
    from palimpsest.sources import containers

    content = compound({"WordDocument": b"w" * 100, "Data": b"d" * 700})
    file = containers.CompoundFile(content)
    assert {e["name"]: file.read(e) for e in file.entries if e["kind"] == 2} == {"WordDocument": b"w" * 100, "Data": b"d" * 700}
    package = io.BytesIO()
    with zipfile.ZipFile(package, "w") as archive:
        archive.writestr("mimetype", "application/vnd.oasis.opendocument.text")
        archive.writestr("content.xml", "<x/>")
    rows = [("a", content), ("b", package.getvalue()), ("c", b"%PDF-1.7"), ("d", office("x", "y"))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = containers.inspect_containers(df.where("path = 'a'"), containers.compound_streams).collect()
    assert sorted((r.member, r.size, r.complete) for r in got) == [("Data", 700, True), ("WordDocument", 100, True)]
    got = {(r.path, r.member) for r in containers.inspect_containers(df.where("path <> 'a'"), containers.package_members).collect()}
    assert got == {("b", "mimetype"), ("b", "content.xml"), ("c", None), ("d", None)}
    kinds = {r.path: r.m for r in df.select("path", media_type(F.col("content")).alias("m")).collect()}
    assert kinds == {"a": "application/x-ole-storage", "b": "application/zip", "c": "application/pdf", "d": "application/zip"}
    one = containers.deterministic_tar({"b": b"2", "a": b"1"})
    assert one == containers.deterministic_tar({"a": b"1", "b": b"2"})


def test_each_member_is_complete_on_its_own():
    from palimpsest.sources import containers

    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        package = io.BytesIO()
        with zipfile.ZipFile(package, "w") as archive:
            archive.writestr("mimetype", "application/vnd.oasis.opendocument.text")
            archive.writestr("content.xml", bytes(range(256)) * 20, method)
            archive.writestr("styles.xml", "<y/>", method)
            at = archive.getinfo("content.xml").header_offset + 30 + len("content.xml")
        whole = package.getvalue()
        broken = whole[: at + 50] + bytes(b ^ 255 for b in whole[at + 50 : at + 60]) + whole[at + 60 :]
        assert [(m["member"], m["complete"]) for m in containers.package_members(whole)] == [("mimetype", True), ("content.xml", True), ("styles.xml", True)]
        assert [(m["member"], m["complete"]) for m in containers.package_members(broken)] == [("mimetype", True), ("content.xml", False), ("styles.xml", True)]


def test_two_readers_of_packages(spark):
    def package(*members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("mimetype", "application/vnd.oasis.opendocument.text")
            for name, data in members:
                archive.writestr(name, data, zipfile.ZIP_DEFLATED)
        return out.getvalue()

    good = package(("content.xml", "<a/>" * 50), ("內容.xml", "x"))
    assert containers.directory_members(good) == containers.package_members(good) and len(containers.package_members(good)) == 3
    for bad in (b"no zip", package()[:-30]):
        with pytest.raises((ValueError, zipfile.BadZipFile)):
            containers.directory_members(bad)
    torn = bytearray(good)
    at = good.index(b"content.xml") + len("content.xml") + 4
    torn[at] ^= 0xFF
    assert [m["complete"] for m in containers.directory_members(bytes(torn))] == [True, False, True]
    files = spark.createDataFrame([("good", bytearray(good)), ("torn", bytearray(torn)), ("none", bytearray(b"no zip"))], "path string, content binary")
    assert containers.reviewed_containers(files).collect() == []


def test_json_shapes(spark):
    from palimpsest.functions import jsons

    df = spark.createDataFrame([('{"a":[1,{"token":2}]}',), ("[]",), ("no",), (None,)], "j string")
    j = F.col("j")
    got = df.select(jsons.json_shape(j).alias("s"), jsons.has_key(j, "token").alias("k"), jsons.json_type(j, "$.a").alias("t")).collect()
    assert [(tuple(r.s) if r.s else None, r.k, r.t) for r in got] == [((4, 5), True, "array"), ((1, 1), False, None), (None, None, None), (None, None, None)]


def test_reader_highlight():
    from palimpsest.operators.tagging import highlight

    assert highlight([(0, 2, 1), (0, 4, 2), (3, 9, 0), (4, 5, 0), (4, 5, 1)]) == [(0, 4, 2), (4, 5, 0)]
