"""Queries of e-mail threads and narratives."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import email, mapping
from ..rules import email as rules
from ..rules import mapping as mapping_rules
from ..sources import readers
from .registry import Inputs, query

# Threads: every customer is a thread, its orders are paragraphs in order of their number.
SUBJECT = "SELECT o_orderkey AS doc_id, CAST(0 AS BIGINT) AS ord, 'GL Submission TARGET: $' || CASE o_custkey % 4 WHEN 0 THEN o_custkey || 'K' WHEN 1 THEN '1,' || (100 + o_custkey % 900) WHEN 2 THEN o_custkey || 'm' ELSE 'none' END || ' - x' AS text FROM {orders} UNION ALL SELECT o_orderkey, 1, 'TARGET: $7' FROM {orders}"


@query("eml1_target_premium", """SELECT o_orderkey AS doc_id, CASE o_custkey % 4 WHEN 0 THEN o_custkey * 1000.0 WHEN 1 THEN 1000.0 + 100 + o_custkey % 900 WHEN 2 THEN o_custkey * 1000000.0 END::DOUBLE AS target_premium FROM {orders}""")
def _(t: Inputs):
    return email.subject_facts(t.sql(SUBJECT)).select("doc_id", "target_premium")


STAMPS = """SELECT o_custkey AS doc_id, CAST(o_orderkey % 2 AS INT) AS table_no, o_orderkey AS row_no, 0 AS col_no, CASE WHEN o_orderkey % 5 = 0 THEN 'no time' ELSE 'Sent ' || CASE month(o_orderdate) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar'
  WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'Dec' END || ' ' || CAST(day(o_orderdate) AS STRING) || ', ' || CAST(year(o_orderdate) AS STRING) || ', ' || (o_custkey % 12 + 1)
  || ':' || (10 + o_orderkey % 50) || CASE WHEN o_orderkey % 2 = 0 THEN chr(160) ELSE ' ' END || 'PM' END AS text, o_orderdate FROM {orders}"""


@query("eml2_date_received", f"""WITH s AS ({STAMPS}), f AS (SELECT doc_id, min(table_no) AS table_no FROM s GROUP BY doc_id)
SELECT s.doc_id, strftime(arg_max(CAST(s.o_orderdate AS TIMESTAMP) + to_hours(CAST((s.doc_id % 12 + 1) % 12 + 12 AS INT)) + to_minutes(CAST(10 + s.row_no % 50 AS INT)), s.row_no), '%Y-%m-%d %H:%M:%S') AS date_received
FROM s JOIN f ON s.doc_id = f.doc_id AND s.table_no = f.table_no WHERE s.row_no % 5 > 0 GROUP BY s.doc_id""")
def _(t: Inputs):
    return email.date_received(t.sql(STAMPS).drop("o_orderdate")).withColumn("date_received", F.date_format("date_received", "yyyy-MM-dd HH:mm:ss"))


DEADLINES = """SELECT o_custkey AS doc_id, o_orderkey AS ord, CASE o_orderkey % 7 WHEN 0 THEN 'Quote due: 5/' || (o_custkey % 40 + 1) || '/26 please' WHEN 1 THEN 'we need' WHEN 2 THEN 'by' WHEN 3 THEN '12/' || (o_custkey % 28 + 1) || ' thanks' WHEN 4 THEN ''
  WHEN 5 THEN CASE WHEN o_custkey % 19 = 0 THEN 'mind the brush' ELSE 'hello' END ELSE o_orderpriority END AS text FROM {orders}"""


@query("eml3_quote_deadline", f"""WITH p AS (SELECT doc_id, string_agg(lower(text), ' ' ORDER BY ord) AS t FROM ({DEADLINES}) WHERE text <> '' GROUP BY doc_id),
f AS (SELECT doc_id, contains(t, 'asap') OR contains(t, 'rush') AS urgent, nullif(regexp_extract(t, '{rules.DEADLINE}', 1), '') AS d FROM p)
SELECT doc_id, CASE WHEN urgent THEN 'ASAP' ELSE coalesce(CAST(CAST(coalesce(try_strptime(CASE WHEN regexp_matches(d, '^\\d+/\\d+/\\d{{2}}$') THEN regexp_replace(d, '(\\d+)$', '20\\1') END, ['%m/%d/%Y', '%d/%m/%Y'])) AS DATE) AS VARCHAR), d) END AS quote_needed_by FROM f WHERE urgent OR d IS NOT NULL""".replace("{{2}}", "{2}"))
def _(t: Inputs):
    return email.quote_deadline(t.sql(DEADLINES))


# Sessions: the events of a user; a sign-up opens a signature, an error closes it.
EVENTS = "SELECT user_id AS doc_id, event_id AS ord, CASE event_type WHEN 'signup' THEN 'Best Regards,' WHEN 'error' THEN 'From: someone' ELSE 'value ' || event_id END AS text FROM {events}"


@query("eml4_signature_sessions", """WITH e AS (SELECT user_id, event_id, event_type, max(CASE WHEN event_type = 'signup' THEN event_id END) OVER w AS o, max(CASE WHEN event_type = 'error' THEN event_id END) OVER w AS c FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id AS doc_id, o AS session, event_id AS ord, 'value ' || event_id AS text FROM e WHERE event_type NOT IN ('signup', 'error') AND o > coalesce(c, -1)""")
def _(t: Inputs):
    return email.signature_lines(t.sql(EVENTS))


# Signature blocks: seven lines per order after an opener.
SIG = {1: "CASE o_custkey % 3 WHEN 0 THEN 'Pat Example | Senior Broker' WHEN 1 THEN 'Kim Sample' ELSE '12 tables' END", 2: "CASE o_custkey % 4 WHEN 0 THEN 'Account Manager' ELSE 'x' END", 3: "CASE o_custkey % 5 WHEN 0 THEN 'Sample Brokerage LLC' WHEN 1 THEN 'Oak Holdings' ELSE 'y' END",
       4: "'p' || o_custkey || '@example.com 555-010-' || (1000 + o_custkey % 9000)", 5: "'License # A' || o_orderkey", 6: "CASE WHEN o_custkey % 2 = 0 THEN '12 Oak Street' ELSE 'z' END", 7: "'Springfield, NY 10001'"}
SIG_LINES = "SELECT o_custkey AS doc_id, o_orderkey * 10 AS ord, 'Thanks,' AS text FROM {orders}" + "".join(f" UNION ALL SELECT o_custkey, o_orderkey * 10 + {i}, {v} FROM {{orders}}" for i, v in SIG.items())
PARSED = """SELECT o_custkey AS doc_id, o_orderkey * 10 AS session, CASE o_custkey % 3 WHEN 0 THEN 'Pat Example' WHEN 1 THEN 'Kim Sample' ELSE CASE WHEN o_custkey % 4 = 0 THEN 'Account Manager' WHEN o_custkey % 5 = 1 THEN 'Oak Holdings' END END AS name,
CASE WHEN o_custkey % 3 = 0 THEN 'Senior Broker' WHEN o_custkey % 4 = 0 THEN 'Account Manager' WHEN o_custkey % 5 = 0 THEN 'Sample Brokerage LLC' END AS title,
CASE o_custkey % 5 WHEN 0 THEN 'Sample Brokerage LLC' WHEN 1 THEN 'Oak Holdings' END AS company, 'p' || o_custkey || '@example.com' AS email, '555-010-' || (1000 + o_custkey % 9000) AS phone, 'A' || o_orderkey AS license,
CASE WHEN o_custkey % 2 = 0 THEN '12 Oak Street | ' ELSE '' END || 'Springfield, NY 10001' AS address FROM {orders}"""


def parsed(t: Inputs):
    return email.signatures(email.signature_lines(t.sql(SIG_LINES)))


@query("eml5_signatures", PARSED)
def _(t: Inputs):
    return parsed(t)


MERGED = f"""s AS ({PARSED}), m AS (SELECT doc_id, name, min(session) AS session, any_value(title) AS title, any_value(company) AS company, any_value(email) AS email, any_value(phone) AS phone, arg_min(license, session) AS license, any_value(address) AS address FROM s WHERE name IS NOT NULL GROUP BY doc_id, name
  UNION ALL SELECT doc_id, name, session, title, company, email, phone, license, address FROM s WHERE name IS NULL)"""


@query("eml6_merged_signatures", f"WITH {MERGED} SELECT * FROM m")
def _(t: Inputs):
    return email.merge_signatures(parsed(t))


KNOWN = "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 2 = 0 THEN 'agent' ELSE 'insured' END AS side, CASE WHEN c_custkey % 7 < 3 THEN 'p' || c_custkey || '@example.com' END AS email FROM {customer}"


@query("eml7_routed_contacts", f"""WITH {MERGED}, r AS (SELECT *, CASE WHEN regexp_matches(lower(coalesce(company, '')), '{rules.AGENT_SIDE}') OR regexp_matches(lower(coalesce(title, '')), '{rules.AGENT_SIDE}') THEN 'agent' ELSE 'insured' END AS side FROM m)
SELECT r.doc_id, r.side, CASE WHEN r.side = 'agent' THEN 'Producer' END AS type, r.name, r.title, r.email, r.phone FROM r WHERE NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.doc_id = r.doc_id AND k.side = r.side AND k.email = r.email)""")
def _(t: Inputs):
    return email.contacts(email.merge_signatures(parsed(t)), t.sql(KNOWN))


SPARK_PARAGRAPHS = "SELECT doc_id, CAST(l AS BIGINT) AS ord, line AS text FROM (SELECT doc_id, posexplode(split(text, '\\n')) AS (l, line) FROM {documents})"
PARAGRAPHS = "SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS ord, unnest(ls) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {documents})"


@query("map16_operations_text", f"SELECT doc_id, left(string_agg(text, ' ' ORDER BY ord), 2000) AS operations FROM ({PARAGRAPHS}) WHERE text <> '' GROUP BY doc_id")
def _(t: Inputs):
    return mapping.operations_text(t.sql(SPARK_PARAGRAPHS), limit=mapping_rules.OPERATIONS_LIMIT, block=4)


@query("map16_operations_whole", f"SELECT doc_id, string_agg(text, ' ' ORDER BY ord) AS operations FROM ({PARAGRAPHS}) WHERE text <> '' GROUP BY doc_id")
def _(t: Inputs):
    return mapping.operations_text(t.sql(SPARK_PARAGRAPHS), block=4)


@query("src5_clean_paragraphs", f"SELECT doc_id, ord, trim(text) AS text FROM ({PARAGRAPHS}) WHERE trim(text) <> ''")
def _(t: Inputs):
    return readers.clean_paragraphs(t.sql(SPARK_PARAGRAPHS))


@query("src5_paragraph_counts", f"""WITH p AS (SELECT doc_id, count(*) AS n FROM ({PARAGRAPHS}) WHERE trim(text) <> '' GROUP BY doc_id), c AS (SELECT conv_id AS doc_id, count(DISTINCT turn) AS n FROM {{conversations}} WHERE trim(text) <> '' GROUP BY conv_id)
SELECT coalesce(p.doc_id, c.doc_id) AS doc_id, coalesce(p.n, 0) AS n_paragraphs, coalesce(c.n, 0) AS n_tables FROM p FULL JOIN c ON p.doc_id = c.doc_id""")
def _(t: Inputs):
    return readers.paragraph_counts(t.sql(SPARK_PARAGRAPHS), t.sql("SELECT conv_id AS doc_id, turn AS table_no, text FROM {conversations}"))
