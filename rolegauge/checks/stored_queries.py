"""Questions over stored reports, users, contacts, files and attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rolegauge.checks import corpus as X
from rolegauge.checks import files as Files
from rolegauge.checks.plans import planned
from rolegauge.checks.sentences import AS_OF_YEAR
from rolegauge.checks.sql import base as B
from rolegauge.checks.sql import stored as S
from rolegauge.operators import history as H
from rolegauge.operators import validation as V
from rolegauge.operators.rate_limit import rate_limit
from rolegauge.plans.scan import scan
from rolegauge.schemas import STORED_REPORTS_DDL, conform, schema
from rolegauge.sources import catalog as Cat
from rolegauge.sources import files as Read
from rolegauge.sources import reports as R
from rolegauge.storage import new_folder


def seconds(column):
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def access(spark, folder):
    return H.access_pairs(X.users(spark, folder))


@planned
def recent(spark, folder):
    return H.newest(X.reports(spark, folder), access(spark, folder))


def contacts_recent(spark, folder):
    return H.recent_contacts(X.contacts(spark, folder), X.users(spark, folder)).select(
        "id", "name", "email", "subject", "message", seconds("created_at").alias("created_s"), "username"
    )


def reports_accessible(spark, folder):
    return H.accessible(X.reports(spark, folder), access(spark, folder)).select("viewer_id", "id", "user_id", "filename", "score")


def access_pairs(spark, folder):
    return access(spark, folder)


def report_by_id(spark, folder):
    """Every event asks for the report before it; the owner of most of them is somebody else."""
    asked = X.table(spark, folder, "events").select(
        (F.col("event_id") - F.col("event_id") % 3).alias("report_id"), F.col("user_id").alias("viewer_id"),
        F.col("event_id").alias("request_id"),
    )
    found = R.with_payload(H.looked_up(asked, X.reports(spark, folder), access(spark, folder)))
    shown = lambda value: F.coalesce(value, F.lit("None"))
    jobs = F.transform("matched_jobs", lambda j: F.concat(shown(j["title"]), F.lit("="), shown(j["match_score"])))
    criteria = F.transform(F.map_entries("criteria"), lambda c: F.concat(c["key"], F.lit("="), c["value"]))
    analysis = F.col("analysis")
    return found.select(
        "request_id", "report_id", "viewer_id", "filename", "score", F.array_join(jobs, "|").alias("jobs"), F.array_join(criteria, "|").alias("criteria"),
        F.array_join("suggestions", "|").alias("suggestions"), analysis["word_count"].alias("word_count"), analysis["score_details"]["Skills"].alias("reason"),
        analysis["bullet_rewrites"][0]["after"].alias("rewrite"), analysis["analysis_steps"][0]["detail"].alias("step"),
    )


def previous_at_scan(spark, folder):
    """New reports of the corpus documents, spread over the time of the stored ones."""
    stored = X.reports(spark, folder)
    span = X.table(spark, folder, "events").select(F.min("ts").alias("first"), F.max("ts").alias("last"))
    at = F.timestamp_micros(F.unix_micros(F.col("first").cast("timestamp")) + F.pmod(F.col("doc_id") * 7919 * 1_000_003, F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))))
    new = X.table(spark, folder, "documents").withColumns({"first": span.select("first").scalar(), "last": span.select("last").scalar()})
    new = new.select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("doc_id") % 150).alias("user_id"), at.alias("uploaded_at"))
    return H.previous_at_scan(new, stored, "doc_id")


def admin_counts(spark, folder):
    return H.counts(X.reports(spark, folder), X.users(spark, folder), X.catalog(spark, folder))


def dashboard(spark, folder):
    return H.dashboard(recent(spark, folder))


def dashboard_trend(spark, folder):
    return H.trend(recent(spark, folder))


def history_recent(spark, folder):
    return recent(spark, folder).select(
        "viewer_id", "place", "id", "filename", "score", R.match_summary(F.col("matched_jobs")).alias("summary")
    )


def latest_score(spark, folder):
    return H.latest_score(X.reports(spark, folder))


def score_progress(spark, folder):
    return H.score_progress(X.reports(spark, folder))


def backfill_owner(spark, folder):
    primary = H.key_users(X.users(spark, folder)).select("primary_id")
    return R.backfill_owner(X.reports(spark, folder), primary).select("id", "user_id", "score")


def report_lines(spark, folder):
    return R.export_lines(X.reports(spark, folder))


def schema_conform(spark, folder):
    """Reports of an older shape next to current ones."""
    new = X.reports(spark, folder)
    shape = schema(STORED_REPORTS_DDL)
    old = new.select((-F.col("id")).alias("id"), "filename", "uploaded_at", "score", F.lit(1).alias("dropped_later"))
    both = conform(old, shape).unionByName(conform(new, shape))
    return both.select("id", "user_id", "filename", "score", "suggestions")


def new_names(spark, folder):
    """Usernames somebody wants to register, in order of ``n``."""
    number = F.col("conv_id")
    name = X.pick_text(
        number, 5,
        F.concat(F.lit("user_"), (number % 150).cast("string")), F.concat(F.lit("guest."), (number % 40).cast("string")),
        F.concat(F.lit(" a"), (number % 7).cast("string"), F.lit(" ")), F.concat(F.lit("bad name "), number.cast("string")),
        F.concat(F.lit("conv-"), number.cast("string")),
    )
    return X.table(spark, folder, "conversations").select((number * 1000 + F.col("turn")).alias("n"), name.alias("username"))


def users_insert_new(spark, folder):
    return H.new_users(new_names(spark, folder), X.users(spark, folder), "n").select("n", "username")


def validate_usernames(spark, folder):
    taken = X.users(spark, folder).select(F.col("username").alias("known"))
    names = new_names(spark, folder)
    return names.join(taken, V.strip(names["username"]) == taken["known"], "left").select(
        "n", "username", V.username_reason(F.col("username"), F.col("known").isNotNull()).alias("reject_reason")
    )


def validate_contacts(spark, folder):
    reason = V.contact_reason(F.col("name"), F.col("email"), F.col("subject"), F.col("message"))
    return X.contacts(spark, folder).select("id", reason.alias("reject_reason"))


def new_roles(spark, folder):
    return X.table(spark, folder, "benchmark").select(
        "item_id", F.when(F.col("item_id") % 9 == 2, F.lit(" \n")).otherwise(F.concat(F.lit(" New role "), F.col("item_id").cast("string"), F.lit(" "))).alias("title"),
        F.when(F.col("item_id") % 7 == 3, F.lit("")).otherwise(F.repeat(F.concat(F.lit("skill "), F.col("item_id").cast("string"), F.lit(", ")), (F.col("item_id") * 3).cast("int"))).alias("keywords"),
        F.col("text").alias("description"),
    )


def validate_catalog(spark, folder):
    reason = V.catalog_reason(F.col("title"), F.col("keywords"), F.col("description"))
    return new_roles(spark, folder).select("item_id", reason.alias("reject_reason"))


def catalog_read(spark, folder):
    """The catalog written as CSV and read from there."""
    path = new_folder(spark, "catalog")
    Cat.write_catalog(X.catalog(spark, folder), path)
    return Cat.read_catalog(spark, path)


def report_roundtrip(spark, folder):
    """Every line of the reports that a scan has written, read through the stored table."""
    docs, path = X.corpus(spark, folder), new_folder(spark, "reports")
    found = scan(docs, X.catalog(spark, folder), AS_OF_YEAR)
    ids = R.report_ids(docs, "doc_id", R.read_reports(spark, path))
    R.append_reports(found.join(ids, "doc_id").drop("doc_id"), path)
    return R.export_lines(R.read_reports(spark, path))


def catalog_append(spark, folder):
    return Cat.append_roles(X.catalog(spark, folder), new_roles(spark, folder), "item_id")


def ingest_accept(spark, folder):
    return Files.files(spark, folder).select(
        "doc_id", "filename", V.extension(F.col("filename")).alias("ext"),
        V.accepted_file(F.col("filename"), F.col("length")).alias("accepted"),
    )


def ingest_signature(spark, folder):
    ext = V.extension(F.col("filename"))
    return Files.files(spark, folder).select("doc_id", ext.alias("ext"), V.signature_matches(F.col("content"), ext).alias("fits"))


def ingest_text(spark, folder):
    return Files.split_bytes(spark, folder).select("doc_id", Read.decode_text(F.col("content")).alias("raw_text"))


def ingest_docx(spark, folder):
    docs = X.table(spark, folder, "documents")
    plain = F.regexp_replace("text", r"[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]", "?")
    return docs.select("doc_id", Read.docx_texts(Files.docx_bytes(plain)).alias("raw_text"))


def ingest_rejects(spark, folder):
    rows = Files.files(spark, folder).select(
        F.col("filename").alias("path"), V.extension(F.col("filename")).alias("ext"), "content", "length"
    )
    accepted = rows.filter(V.accepted_file(F.col("path"), F.col("length")))
    return Read.extracted(accepted).select("path", "ext", F.length("raw_text").alias("n_chars"), "reject_reason")


def validate_scan(spark, folder):
    files = Files.files(spark, folder)
    docs = X.corpus(spark, folder).select("doc_id", "title", "description")
    long_title = F.when(F.col("doc_id") % 10 == 2, F.repeat(F.lit("long "), 40)).otherwise(F.col("title"))
    text = F.when(F.col("doc_id") % 4 == 3, F.lit(" \n ")).otherwise(Read.decode_text(F.col("content")))
    name = F.when(F.col("doc_id") % 17 == 0, F.lit("")).otherwise(F.col("filename"))
    return files.join(docs, "doc_id").select(
        "doc_id", V.scan_reason(name, long_title, F.col("description"), F.col("content"), text).alias("reject_reason")
    )


def rate_limited(spark, folder):
    attempts = X.attempts(spark, folder)
    return rate_limit(attempts, ["action", "client"], "ts", "attempt_id", S.LIMIT, S.SECONDS).select(
        "action", "client", "attempt_id", "accepted"
    )


ENTRIES = {
    "contacts_recent": (
        contacts_recent,
        """SELECT c.id, c.name, c.email, c.subject, c.message, c.created_s, u.username
        FROM k_contacts c LEFT JOIN k_users u ON u.id = c.user_id ORDER BY c.created_s DESC, c.id DESC LIMIT 20""",
    ),
    "reports_accessible": (
        reports_accessible,
        "SELECT a.viewer_id, r.id, r.user_id, r.filename, r.score FROM k_reports r JOIN k_access a ON r.user_id = a.owner_id",
    ),
    "access_pairs": (access_pairs, "SELECT viewer_id, owner_id FROM k_access"),
    "report_by_id": (
        report_by_id,
        """SELECT e.event_id AS request_id, r.id AS report_id, e.user_id AS viewer_id, r.filename, r.score,
          array_to_string(list_transform(r.jobs, lambda j: j.title || '=' || coalesce(j.match_score, 'None')), '|') AS jobs,
          array_to_string(list_transform(r.criteria, lambda c: c.name || '=' || c.value), '|') AS criteria, array_to_string(r.suggestions, '|') AS suggestions,
          CASE WHEN r.analyzed THEN r.id::INTEGER END AS word_count, CASE WHEN r.analyzed THEN 'Detected explicit skills.' END AS reason,
          CASE WHEN r.analyzed THEN 'Delivered ' || r.id END AS rewrite, CASE WHEN r.analyzed THEN r.id || ' words' END AS step
        FROM events e JOIN k_reports r ON r.id = e.event_id - e.event_id % 3
        WHERE EXISTS (SELECT 1 FROM k_access a WHERE a.viewer_id = e.user_id AND a.owner_id = r.user_id)""",
    ),
    "admin_counts": (
        admin_counts,
        """SELECT (SELECT count(*) FROM k_reports) AS report_count, (SELECT count(*) FROM k_users) AS user_count,
        (SELECT count(*) FROM k_catalog) AS role_count""",
    ),
    "dashboard": (
        dashboard,
        f"""SELECT viewer_id, count(*) AS total_scans, coalesce({B.half_even('avg(score)')}, 0) AS average_score,
        coalesce(max(score), 0) AS best_score FROM k_recent GROUP BY viewer_id""",
    ),
    "dashboard_trend": (
        dashboard_trend,
        """SELECT viewer_id, scan_no::INTEGER AS scan_no, 'Scan ' || scan_no AS label, score FROM (
          SELECT *, row_number() OVER (PARTITION BY viewer_id ORDER BY newest DESC) AS scan_no FROM (
            SELECT *, row_number() OVER (PARTITION BY viewer_id ORDER BY place) AS newest FROM k_recent WHERE score IS NOT NULL)
          WHERE newest <= 8)""",
    ),
    "history_recent": (
        history_recent, "SELECT viewer_id, place::INTEGER AS place, id, filename, score, summary FROM k_recent",
    ),
    "latest_score": (
        latest_score,
        """SELECT user_id, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY uploaded_at DESC, id DESC) AS n
        FROM k_reports) WHERE n = 1""",
    ),
    "score_progress": (
        score_progress,
        """SELECT id, user_id, score, previous_score, CASE WHEN previous_score IS NOT NULL THEN score >= previous_score END AS not_worse
        FROM (SELECT *, lag(score) OVER (PARTITION BY user_id ORDER BY uploaded_at, id) AS previous_score FROM k_reports)""",
    ),
    "previous_at_scan": (
        previous_at_scan,
        """SELECT doc_id, score AS previous_score FROM (
          SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN doc_id % 150 ELSE -1 END AS owner, make_timestamp(a + (doc_id * 7919 * 1000003) % (b - a)) AS asked_at
          FROM documents, (SELECT epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM events)) new
        ASOF LEFT JOIN (SELECT coalesce(user_id, -1) AS owner, uploaded_at AS asked_at, score FROM k_reports) old USING (owner, asked_at)""",
    ),
    "backfill_owner": (
        backfill_owner, "SELECT id, coalesce(user_id, (SELECT primary_id FROM k_keys)) AS user_id, score FROM k_reports",
    ),
    "report_lines": (
        report_lines,
        "SELECT id, line_no::INTEGER AS line_no, line FROM k_lines_out",
    ),
    "schema_conform": (
        schema_conform,
        f"""SELECT -id AS id, NULL::BIGINT AS user_id, filename, score, NULL AS suggestions FROM k_reports
        UNION ALL SELECT id, user_id, filename, score,
          {S.choose(5, '''\'["Add detail ' || n || '", "Use numbers"]\'''', "'[]'", 'NULL', """'{"a": 1}'""", '''\'[\'\'Legacy advice\'\']\'''')}
        FROM (SELECT *, id AS n FROM k_reports)""",
    ),
    "users_insert_new": (
        users_insert_new,
        f"""SELECT min(n) AS n, {S.STRIPPED_NAME} AS username FROM k_new_names
        WHERE {S.STRIPPED_NAME} NOT IN (SELECT username FROM k_users) AND length({S.STRIPPED_NAME}) >= 3
          AND regexp_full_match({S.STRIPPED_NAME}, '[A-Za-z0-9_.\\-]+') GROUP BY 2""",
    ),
    "validate_usernames": (
        validate_usernames,
        f"""SELECT n, username, CASE WHEN length({S.STRIPPED_NAME}) < 3 THEN 'too short'
          WHEN NOT regexp_full_match({S.STRIPPED_NAME}, '[A-Za-z0-9_.\\-]+') THEN 'characters'
          WHEN {S.STRIPPED_NAME} IN (SELECT username FROM k_users) THEN 'taken' END AS reject_reason FROM k_new_names""",
    ),
    "validate_contacts": (
        validate_contacts,
        f"""SELECT id, CASE WHEN trim(name) = '' OR trim(email) = '' OR {B.strip('message')} = '' THEN 'field missing'
          WHEN NOT regexp_full_match(trim(email), '{B.EMAIL}') THEN 'email'
          WHEN length({B.strip('message')}) > 5000 THEN 'too long' END AS reject_reason FROM k_contacts""",
    ),
    "validate_catalog": (
        validate_catalog,
        f"""SELECT item_id, CASE WHEN item_id % 9 = 2 OR item_id % 7 = 3 OR item_id = 0 THEN 'field missing'
          WHEN length({B.strip("repeat('skill ' || item_id || ', ', item_id * 3)")}) > 800 OR length({B.strip('text')}) > 800 THEN 'too long' END AS reject_reason
        FROM benchmark""",
    ),
    # The lines of a whole scan have no short SQL form; their parts are compared in report_build and report_lines.
    "report_roundtrip": (report_roundtrip, None),
    "catalog_read": (catalog_read, "SELECT job_id, title, keywords, description FROM k_catalog"),
    "catalog_append": (
        catalog_append,
        f"""SELECT job_id, title, keywords, description FROM k_catalog UNION ALL
        SELECT (SELECT max(job_id) FROM k_catalog) + row_number() OVER (ORDER BY item_id),
          'New role ' || item_id, {B.strip("repeat('skill ' || item_id || ', ', item_id * 3)")}, {B.strip('text')}
        FROM benchmark WHERE item_id % 9 <> 2 AND item_id % 7 <> 3 AND item_id <> 0
          AND length({B.strip("repeat('skill ' || item_id || ', ', item_id * 3)")}) <= 800 AND length({B.strip('text')}) <= 800""",
    ),
    "ingest_accept": (
        ingest_accept,
        """SELECT doc_id, filename, ext, coalesce(ext IN ('pdf', 'txt', 'docx'), false) AND size <= 10485760 AS accepted FROM k_typed_files""",
    ),
    "ingest_signature": (ingest_signature, "SELECT doc_id, ext, fits FROM k_signed_files"),
    "ingest_text": (ingest_text, "SELECT doc_id, text || text AS raw_text FROM documents"),
    "ingest_docx": (
        ingest_docx,
        r"""SELECT doc_id, t || chr(10) || 'lines' || chr(10) || len(string_split(t, chr(10))) AS raw_text
        FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]', '?', 'g') AS t FROM documents)""",
    ),
    "ingest_rejects": (
        ingest_rejects,
        """SELECT filename AS path, ext, CASE WHEN fits THEN CASE WHEN ext = 'txt' THEN length(body) ELSE 0 END END::INTEGER AS n_chars,
          CASE WHEN NOT fits THEN 'signature' WHEN ext <> 'txt' THEN 'no readable text' END AS reject_reason
        FROM k_signed_files WHERE ext IN ('pdf', 'txt', 'docx') AND size <= 10485760""",
    ),
    "validate_scan": (
        validate_scan,
        """SELECT f.doc_id, CASE WHEN f.doc_id % 17 = 0 THEN 'file missing'
          WHEN NOT coalesce(f.ext IN ('pdf', 'txt', 'docx'), false) THEN 'file type'
          WHEN f.doc_id % 10 = 2 OR length(coalesce(d.description, '')) > 5000 THEN 'target too long'
          WHEN NOT f.fits THEN 'signature' WHEN f.doc_id % 4 = 3 THEN 'no text' END AS reject_reason
        FROM k_signed_files f JOIN k_docs d USING (doc_id)""",
    ),
    "rate_limit": (rate_limited, "SELECT action, client, event_id AS attempt_id, accepted FROM k_limited"),
}
