"""File ingestion from a folder of small files."""

import io
import zipfile

from pyspark.sql import functions as F

from rolegauge.operators import validation as V
from rolegauge.sources import files as S

DOCX = (
    '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'
    "<w:p><w:r><w:t>Alex</w:t></w:r><w:r><w:tab/><w:t>Analyst</w:t></w:r></w:p>"
    "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    "<w:p><w:r><w:t>Python &amp; SQL</w:t></w:r></w:p></w:body></w:document>"
)
MERGED = (
    '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:tbl>'
    '<w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr><w:p><w:r><w:t>wide</w:t></w:r></w:p></w:tc>'
    '<w:tc><w:tcPr><w:vMerge w:val="restart"/></w:tcPr><w:p><w:r><w:t>tall</w:t></w:r></w:p></w:tc></w:tr>'
    "<w:tr><w:tc><w:p/></w:tc><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr><w:p/></w:tc></w:tr>"
    "</w:tbl></w:body></w:document>"
)


def docx(body=DOCX):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("word/document.xml", body)
    return out.getvalue()


def test_damaged_and_merged():
    whole = docx(DOCX * 1 + "<!--" + "x" * 5000 + "-->")
    place = whole.index(b"document.xml") + 12
    assert S.docx_text(whole[:place] + b"\xff" * 40 + whole[place + 40 :]) == ""
    locked = bytearray(docx())
    locked[6] |= 1
    locked[locked.index(b"PK\x01\x02") + 8] |= 1
    assert S.docx_text(bytes(locked)) == ""
    assert S.docx_text(docx(MERGED)) == "wide\nwide\ntall\n\nc\ntall"


def test_names(spark):
    names = ["letter.pdf", "two.parts.DoCx", "n.txt", "letter.zip", "letter", "x.txt."]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(V.accepted_file(F.col("f"), F.lit(5))).collect()] == [True, True, True, False, False, False]
    assert not spark.range(1).select(V.accepted_file(F.lit("a.txt"), F.lit(10 * 1024 * 1024 + 1))).first()[0]


def test_folder(spark, tmp_path):
    contents = {
        "plain.txt": "Alex\nPython ü".encode() + b"\xff\xfe end",
        "blank.txt": b" \n ",
        "nul.txt": b"ab\x00cd",
        "late_nul.txt": b"abcdefgh\x00",
        "good.docx": docx(),
        "broken.docx": b"PK\x03\x04 nothing",
        "fake.docx": b"plain",
        "fake.pdf": b"not a pdf file",
        "scan.pdf": b"%PDF-1.7 ...",
        "tool.exe": b"MZ",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    files = S.read_files(spark, str(tmp_path))
    assert not [f for f in files.inputFiles() if f.endswith("tool.exe")]
    found = S.extracted(files)
    rows = {r["path"].rsplit("/", 1)[1]: (r["raw_text"], r["reject_reason"]) for r in found.collect()}
    assert rows == {
        "plain.txt": ("Alex\nPython ü end", None),
        "blank.txt": (" \n ", S.UNREADABLE),
        "nul.txt": (None, "signature"),
        "late_nul.txt": ("abcdefgh\x00", None),
        "good.docx": ("Alex\tAnalyst\nPython & SQL\na\nb", None),
        "broken.docx": ("", S.UNREADABLE),
        "fake.docx": (None, "signature"),
        "fake.pdf": (None, "signature"),
        "scan.pdf": ("", S.UNREADABLE),
    }


def test_scan_rules(spark):
    rows = [
        (None, "", "", b"x", "x"), ("a.exe", "", "", b"x", "x"), ("a.txt", "t" * 161, "", b"x", "x"), ("a.txt", "", "d" * 5001, b"x", "x"),
        ("a.pdf", "", "", b"not a pdf", "x"), ("a.txt", "", "", b"x", " \n"), ("a.txt", None, None, b"x", "x"),
    ]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, f string, t string, d string, c binary, r string")
    reason = V.scan_reason(F.col("f"), F.col("t"), F.col("d"), F.col("c"), F.col("r"))
    assert [r[0] for r in df.orderBy("n").select(reason).collect()] == [
        "file missing", "file type", "target too long", "target too long", "signature", "no text", None,
    ]


def test_cell_widths_that_are_no_numbers_or_too_large(spark):
    def packed(grid, spans):
        cells = "".join(f'<w:tc><w:tcPr><w:gridSpan w:val="{s}"/></w:tcPr><w:p><w:r><w:t>c{n}</w:t></w:r></w:p></w:tc>' for n, s in enumerate(spans))
        body = f"<w:tbl><w:tblGrid>{'<w:gridCol/>' * grid}</w:tblGrid><w:tr>{cells}</w:tr></w:tbl>"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("word/document.xml", f'<w:document xmlns:w="{S.W[1:-1]}"><w:body>{body}</w:body></w:document>')
        return out.getvalue()

    assert S.docx_text(packed(4, ["x", "2", "", "-1"])).split("\n") == ["c0", "c1", "c1", "c2", "c3"]
    assert S.docx_text(packed(3, ["3000000", "9"])).split("\n") == ["c0", "c0", "c0", "c1"]
    assert len(S.docx_text(packed(0, ["3000000"])).split("\n")) == 63


def test_docx_files_reach_python_a_few_at_a_time(spark):
    df = spark.createDataFrame([(n, docx() if n % 2 else None) for n in range(300)], "n int, content binary").coalesce(1)
    read = df.select("n", S.docx_texts("content").alias("text"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert {r["text"] for r in read.collect() if r["n"] % 2 == 0} == {None}
    assert read.filter("text LIKE 'Alex%'").count() == 150
