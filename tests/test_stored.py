"""Reports, history, validation, numbering."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rolegauge.operators import history as H
from rolegauge.operators import validation as V
from rolegauge.operators.numbering import number_rows
from rolegauge.plans.history import dashboards, exported, recent_history, report_details
from rolegauge.plans.scan import scan, scan_with_previous
from rolegauge.schemas import CONTACTS_DDL, STORED_REPORTS_DDL, USERS_DDL, conform, read_or_empty, schema
from rolegauge.sources import catalog as Cat
from rolegauge.sources import reports as R
from rolegauge.sources.contacts import append_contacts

DAY = datetime(2025, 1, 1)


def users(spark, names):
    return spark.createDataFrame([(n, name, DAY) for n, name in names], USERS_DDL)


def reports(spark, rows):
    """Rows of (id, user, hours, score)."""
    data = [(i, u, f"f{i}.txt", DAY + timedelta(hours=h), s, None, None, None, None) for i, u, h, s in rows]
    return spark.createDataFrame(data, STORED_REPORTS_DDL)


def payload(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "n int, t string").orderBy("n")


def test_payloads(spark):
    values = [
        '[{"title": "A", "match_score": 3}]', "[{'title': 'B', 'note': None, 'ok': True}]", "broken", '"X, Y"', "", None,
        '{"title": "no list"}', '["P", " "]', "[]", "[{'title': 'True North', 'note': None}]", '["P", {"title": "x", "match_score": 7.5}]',
        '[{"title": "x"}, "P"]', "[{'title': 'it\\'s None', 'ok': False}]",
    ]
    out = [
        (r[0], [j["title"] for j in r[1]])
        for r in payload(spark, values).select(R.match_summary(F.col("t")), R.job_list(F.col("t"))).collect()
    ]
    assert [s for s, _ in out] == ["A", "B", "None", "X, Y", "None", "None", "None", "P", "None", "True North", "P, x", "x, P", "it's None"]
    assert [t for _, t in out][:7] == [["A"], ["B"], [], ["X", "Y"], [], [], []]
    assert [t for _, t in out][9:] == [["True North"], ["x"], ["x"], ["it's None"]]


def test_python_literals(spark):
    """Forms that only Python reads: prefixes, adjacent strings, escapes, tuples; numbers are no titles."""
    values = [
        "['a', 5]", "['a' 'b']", "[u'z']", "[{'title': 'A\\x41'}]", "('a', 'b')", "[('a',), 'b']", "'x' ', y'", "{'a'}", "[1, 2", "[" * 3000, "['a', {1: 2}]",
        '["1", 1]', "[b'x', 'y']", "  ['lead']", "[{'title': 5}]", "__import__('os')", '["{x"]', "[{'title': 'a', 'title': 'b'}]",
    ]
    rows = payload(spark, values).select(R.match_summary(F.col("t")), R.job_list(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["a", "ab", "z", "AA", "None", "b", "x, y", "None", "None", "None", "a", "1", "y", "lead", "5", "None", "{x", "b"]
    assert [[j["title"] for j in r[1]] for r in rows][3:7] == [["AA"], [], [], ["x", "y"]]
    assert rows[16][1] == [] and rows[10][1][0]["title"] is None


def test_wrong_kinds_become_empty(spark):
    df = payload(spark, ["[1]", '{"Skills": 7.5, "Education": 1}', None]).select(R.parsed(F.col("t"), R.CRITERIA, "{"))
    got = [r[0] for r in df.collect()]
    assert got[0] is None and got[2] is None and list(got[1].items()) == [("Skills", "7.5"), ("Education", "1")]


def test_report_lines_are_whole_unless_a_page_is_asked_for(spark):
    advice = "[" + ", ".join(f'"{"long " * 30}{n}"' for n in range(60)) + "]"
    df = spark.createDataFrame(
        [(1, 1, "a.txt", DAY, 70, None, '{"Skills": 3}', advice, '{"score_details": {"Skills": "Because."}}')], STORED_REPORTS_DDL
    )
    lines = [r["line"] for r in R.export_lines(df).orderBy("line_no").collect()]
    assert len(lines) == 6 + 2 + 2 + 60 + 2 and max(map(len, lines)) == 2 + 150 + 2
    page = [r["line"] for r in R.export_lines(df, most_lines=42, most_chars=95).orderBy("line_no").collect()]
    assert page == [line[:95] for line in lines[:42]]
    assert lines[1:4] == ["File: a.txt", "Saved: 2025-01-01T00:00:00+00:00", "Score: 70 / 100"]
    assert lines[6:8] == ["- Skills: 3/10", "  Because."]


def test_access(spark):
    people = users(spark, [(1, "admin"), (2, "ann"), (3, "bob")])
    assert H.key_users(people).first().asDict() == {"admin_id": 1, "primary_id": 2}
    assert sorted(map(tuple, H.access_pairs(people).collect())) == [(1, 1), (2, 1), (2, 2), (3, 3)]
    only = users(spark, [(4, "admin")])
    assert list(map(tuple, H.access_pairs(only).collect())) == [(4, 4)]
    nobody = users(spark, [])
    assert H.access_pairs(nobody).count() == 0
    table = reports(spark, [(1, 1, 0, 5), (2, 3, 1, 6), (3, None, 2, 7)])
    assert [r["id"] for r in H.accessible(table, H.access_pairs(people), viewer=2).collect()] == [1]


def test_history(spark):
    people = users(spark, [(1, "admin"), (2, "ann"), (3, "bob")])
    rows = [(n, 2, n, None if n == 29 else n) for n in range(30)] + [(100, 1, 50, 99), (101, 3, 1, None)]
    recent = H.newest(reports(spark, rows), H.access_pairs(people))
    board = {r["viewer_id"]: tuple(r)[1:] for r in H.dashboard(recent).collect()}
    scores = [99] + list(range(28, 10, -1))
    assert board[2] == (20, round(sum(scores) / len(scores)), 99)
    assert board[3] == (1, 0, 0)
    line = [(r["label"], r["score"]) for r in H.trend(recent).filter("viewer_id = 2").orderBy("scan_no").collect()]
    assert line == [(f"Scan {n + 1}", s) for n, s in enumerate(reversed(scores[:8]))]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_average_rounds_half_to_even(spark):
    people = users(spark, [(2, "ann")])
    recent = H.newest(reports(spark, [(1, 2, 0, 2), (2, 2, 1, 3)]), H.access_pairs(people))
    assert H.dashboard(recent).first()["average_score"] == 2


def test_progress_crosses_periods_and_groups_the_anonymous(spark):
    rows = [(1, None, 0, 5), (2, None, 30, None), (3, None, 31, 7), (4, 9, 0, 1), (5, 9, 100, 3), (6, 9, 100, 2)]
    got = {r["id"]: (r["previous_score"], r["not_worse"]) for r in H.score_progress(reports(spark, rows)).collect()}
    assert got == {1: (None, None), 2: (5, None), 3: (None, None), 4: (None, None), 5: (1, True), 6: (3, False)}
    last = {r["user_id"]: r["score"] for r in H.latest_score(reports(spark, rows)).collect()}
    assert last == {None: 7, 9: 2}


def test_previous_score_at_scan_time(spark):
    """A hot owner cut into parts, equal times, anonymous owners, reports without a score, against a plain search."""
    old = [(n, 7 if n % 3 else None, n % 40, None if n % 9 == 0 else n % 100) for n in range(300)] + [(900, 8, 5, 50)]
    new = [(n, [7, None, 8, 99][n % 4], n % 45) for n in range(120)]
    asked = spark.createDataFrame([(k, u, DAY + timedelta(hours=h)) for k, u, h in new], "doc_id bigint, user_id bigint, uploaded_at timestamp")
    got = {r["doc_id"]: r["previous_score"] for r in H.previous_at_scan(asked, reports(spark, old), "doc_id").collect()}
    newest = lambda u, h: max(((at, i, score) for i, owner, at, score in old if owner == u and at <= h), key=lambda r: r[:2], default=(0, 0, None))[2]
    assert got == {k: newest(u, h) for k, u, h in new}
    assert H.previous_at_scan(asked, reports(spark, []), "doc_id").filter("previous_score is null").count() == 120


def test_backfill_and_new_users(spark):
    people = users(spark, [(1, "admin"), (2, "ann")])
    filled = R.backfill_owner(reports(spark, [(1, None, 0, 5), (2, 7, 0, 5)]), H.key_users(people).select("primary_id"))
    assert {r["id"]: r["user_id"] for r in filled.collect()} == {1: 2, 2: 7}
    wanted = spark.createDataFrame([(1, "ann"), (2, " bob "), (3, "bob"), (4, "cy"), (5, "bad name"), (6, "cyd")], "n int, username string")
    assert sorted(map(tuple, H.new_users(wanted, people, "n").collect())) == [(2, "bob"), (6, "cyd")]
    table = H.insert_users(wanted, people, "n", F.lit(DAY))
    assert sorted(map(tuple, table.collect())) == [(1, "admin", DAY), (2, "ann", DAY), (3, "bob", DAY), (4, "cyd", DAY)]


def test_numbers_are_consecutive_for_any_distribution(spark):
    values = [10**12, 5, 6, 7, -3, 10**15] + list(range(100, 400))
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = {r["v"]: r["no"] for r in number_rows(df, "no", order="v", start=10).collect()}
    assert got == {v: n + 10 for n, v in enumerate(sorted(values))}


def test_report_ids_follow_the_stored_ones(spark):
    docs = spark.createDataFrame([(7,), (3,), (900,)], "doc_id bigint")
    got = dict(map(tuple, R.report_ids(docs, "doc_id", reports(spark, [(41, 1, 0, 1)])).collect()))
    assert got == {3: 42, 7: 43, 900: 44}


def test_catalog_file_keeps_file_order(spark, tmp_path):
    path = tmp_path / "roles.csv"
    path.write_text('title,keywords,description\nB,"x, y","first, one"\nA,z,\n')
    rows = Cat.read_catalog(spark, str(path)).orderBy("job_id").collect()
    assert [(r["job_id"], r["title"], r["keywords"]) for r in rows] == [(0, "B", "x, y"), (1, "A", "z")]
    assert Cat.read_catalog(spark, None).count() == 5 and Cat.read_catalog(spark, str(tmp_path / "absent.csv")).count() == 5
    rows = [(1, " Falconer ", "hawks, gloves", None), (2, "", "x", ""), (3, "y", " ", "")]
    extra = spark.createDataFrame(rows, "n int, title string, keywords string, description string")
    whole = Cat.append_roles(Cat.default_catalog(spark), extra, "n")
    added = whole.orderBy("job_id").collect()
    assert len(added) == 6 and (added[-1]["job_id"], added[-1]["title"], added[-1]["description"]) == (5, "Falconer", "")
    Cat.write_catalog(whole, str(tmp_path / "whole"))
    again = Cat.read_catalog(spark, str(tmp_path / "whole")).orderBy("job_id").collect()
    assert [(r["job_id"], r["title"], r["keywords"]) for r in again] == [(r["job_id"], r["title"], r["keywords"]) for r in added]


def test_catalog_folder_is_read_by_file_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,keywords,description\nA,z,\n")
    (tmp_path / "b.csv").write_text("title,keywords,description\n" + "".join(f"B{n},z,{'d' * 200}\n" for n in range(500)))
    rows = Cat.read_catalog(spark, str(tmp_path)).orderBy("job_id").collect()
    assert [r["title"] for r in rows] == ["A", *[f"B{n}" for n in range(500)]]


def test_reports_of_a_scan_are_whole(spark, tmp_path):
    """Scan, append, read, look up, export."""
    shape = "doc_id bigint, raw_text string, ext string, title string, description string, user_id bigint, filename string, uploaded_at timestamp"
    docs = spark.createDataFrame([(n, f"kept bees and python for {n} years", "txt", "Beekeeper", "bees hives", 2, f"b{n}.txt", DAY) for n in range(3)], shape)
    path = str(tmp_path / "reports")
    assert R.read_reports(spark, path).count() == 0
    found = scan(docs, Cat.default_catalog(spark), 2026)
    R.append_reports(found.join(R.report_ids(docs, "doc_id", R.read_reports(spark, path)), "doc_id").drop("doc_id"), path)
    stored = R.read_reports(spark, path)
    again = scan_with_previous(docs.withColumn("uploaded_at", F.lit(DAY + timedelta(days=1))), Cat.default_catalog(spark), 2026, stored)
    assert {r["previous_score"] for r in again.collect()} == {stored.orderBy(F.desc("id")).first()["score"]}
    people = users(spark, [(1, "admin"), (2, "ann")])
    asked = spark.createDataFrame([(1, 2), (2, 1)], "report_id bigint, viewer_id bigint")
    lines = [r["line"] for r in exported(asked, stored, people).orderBy("line_no").collect()]
    assert lines[1] == "File: b0.txt" and any(line.startswith("- Skills: ") for line in lines) and "- Beekeeper: " in " ".join(lines)
    details = report_details(asked, stored, people).first()
    assert details["criteria"] and details["suggestions"] and details["matched_jobs"][0]["title"] == "Beekeeper" and details["analysis"]["score_details"]
    assert recent_history(stored, people).filter("place = 1").first()["summary"].startswith("Beekeeper")
    board, line = dashboards(stored, people)
    assert board.filter("viewer_id = 2").first()["total_scans"] == 3 and line.count() == 3
    primary = H.key_users(people).select("primary_id")
    R.write_backfill(stored.withColumn("user_id", F.lit(None).cast("bigint")), primary, str(tmp_path / "filled"))
    assert {r["user_id"] for r in R.read_reports(spark, str(tmp_path / "filled")).collect()} == {2}


def test_schema(spark, tmp_path):
    empty = read_or_empty(spark, str(tmp_path / "none"), schema(USERS_DDL))
    assert empty.count() == 0 and empty.columns == ["id", "username", "created_at"]
    old = spark.createDataFrame([("ann", 1, True)], "username string, id int, extra boolean")
    assert tuple(conform(old, schema(USERS_DDL)).first()) == (1, "ann", None)
    R.append_reports(reports(spark, [(1, 1, 0, 5)]), str(tmp_path / "reports"))
    R.append_reports(reports(spark, [(2, 1, 0, 5)]), str(tmp_path / "reports"))
    assert read_or_empty(spark, str(tmp_path / "reports"), schema(STORED_REPORTS_DDL)).count() == 2


def test_contact_rules(spark):
    rows = [
        ("Al", "not-an-email", "", "Hi"), ("Al", " a@b.io ", "", "Hi"), (" ", "a@b.io", "", "Hi"), ("Al", "a@b.io", "", "x" * 5001),
        ("Al", "a@b.io", None, None),
    ]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, name string, email string, subject string, message string")
    reason = V.contact_reason(F.col("name"), F.col("email"), F.col("subject"), F.col("message"))
    assert [r[0] for r in df.orderBy("n").select(reason).collect()] == ["email", None, "field missing", "too long", "field missing"]


def test_catalog_and_username_rules(spark):
    df = spark.createDataFrame([("t", "k", "d" * 801), ("t", " ", ""), ("t", "k", None)], "t string, k string, d string")
    assert [r[0] for r in df.select(V.catalog_reason(F.col("t"), F.col("k"), F.col("d"))).collect()] == ["too long", "field missing", None]
    df = spark.createDataFrame([("ab", False), ("a b c", False), ("ann", True), ("ann", False), (None, False)], "u string, taken boolean")
    assert [r[0] for r in df.select(V.username_reason(F.col("u"), F.col("taken"))).collect()] == [
        "too short", "characters", "taken", None, "too short",
    ]


def test_contact_table(spark, tmp_path):
    rows = [(1, None, " Al ", "a@b.io", None, "Hi ", DAY), (2, 5, "Bo", "no", "", "Hi", DAY)]
    messages = spark.createDataFrame(rows, CONTACTS_DDL)
    append_contacts(messages, str(tmp_path / "contacts"))
    append_contacts(messages, str(tmp_path / "contacts"))
    stored = spark.read.parquet(str(tmp_path / "contacts")).collect()
    assert [tuple(r)[:6] for r in stored] == [(1, None, "Al", "a@b.io", "", "Hi")] * 2
    people = users(spark, [(5, "ann")])
    newest = H.recent_contacts(messages, people).orderBy("id").collect()
    assert [(r["id"], r["username"]) for r in newest] == [(1, None), (2, "ann")]


def test_pages_as_text(spark, tmp_path):
    R.write_pages(reports(spark, [(1, 1, 0, 5), (2, 1, 0, 6)]), str(tmp_path / "pages"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "pages" / "id=2")).collect()]
    assert lines[1] == "File: f2.txt" and lines[3] == "Score: 6 / 100"
