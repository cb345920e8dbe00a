"""Checks of column functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Registry
from modelweave.functions import scalars as S

R = Registry()


@R.add(
    "f01_quote_name",
    """SELECT p_partkey, '"' || p_name || '"' AS p_name, CASE WHEN regexp_matches(p_type, '[\\s0-9a-z]') THEN '"' || p_type || '"' ELSE p_type END AS p_type,
    CASE WHEN regexp_matches(p_brand, '[\\s0-9a-z]') THEN '"' || p_brand || '"' ELSE p_brand END AS p_brand FROM part""",
)
def _(t):
    return t("part").select(
        "p_partkey",
        S.quote_name("p_name", "always").alias("p_name"),
        S.quote_name("p_type").alias("p_type"),
        S.quote_name("p_brand").alias("p_brand"),
    )


@R.add(
    "f02_escape_quotes",
    """SELECT doc_id, md5('''' || replace(replace(text, 'e ', 'e'' '), '''', '''''') || '''') AS digest FROM documents""",
)
def _(t):
    quoted = F.replace(F.col("text"), F.lit("e "), F.lit("e' "))
    return t("documents").select("doc_id", F.md5(S.escape_quotes(quoted, wrap=True)).alias("digest"))


@R.add(
    "f03_wrap_once",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '"' || o_orderpriority || '"' ELSE '"' || o_orderpriority || '"' END AS name FROM orders""",
)
def _(t):
    name = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).otherwise(F.col("o_orderpriority"))
    return t("orders").select("o_orderkey", S.wrap_once(name, '"', '"').alias("name"))


@R.add(
    "f04_qualified_name",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment || '.' || c_name END AS name FROM customer""",
)
def _(t):
    schema = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return t("customer").select("c_custkey", S.qualified_name(schema, "c_name").alias("name"))


@R.add("f05_indent", "SELECT doc_id, md5('  ' || replace(text, chr(10), chr(10) || '  ')) AS digest FROM documents")
def _(t):
    return t("documents").select("doc_id", F.md5(S.indent("text", "  ")).alias("digest"))


@R.add(
    "f06_comment_out",
    """SELECT d.doc_id, md5(CASE WHEN quality IS NULL OR quality = 1 THEN text WHEN contains(text, chr(10)) THEN '/*' || chr(10) || text || ' */' || chr(10)
    ELSE '-- ' || text END) AS block, md5(CASE WHEN quality IS NULL OR quality = 1 THEN text ELSE '/* ' || text || ' */' END) AS part
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(t):
    active = F.col("quality") == 1
    docs = t("documents").join(t("labels"), "doc_id", "left")
    return docs.select(
        "doc_id", F.md5(S.comment_out("text", active)).alias("block"), F.md5(S.comment_out("text", active, inline=True)).alias("part")
    )


@R.add(
    "f07_render_template",
    """SELECT d.doc_id, 'Document ' || d.doc_id || ' (' || lang || '): ' || coalesce(CAST(quality AS VARCHAR), '') || '/' AS line
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(t):
    docs = t("documents").join(t("labels"), "doc_id", "left")
    columns = {"id": "doc_id", "lang": "lang", "quality": "quality"}
    return docs.select("doc_id", S.render_template("Document ${id} (${lang}): ${quality}/${missing}", columns).alias("line"))


@R.add(
    "f08_extract_after",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE least(o_orderkey, o_custkey) END AS start FROM orders""",
)
def _(t):
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("INCREMENT BY 1 START WITH  "), "o_custkey", F.lit(" CACHE 20"))).otherwise(
        F.lit("INCREMENT BY 1")
    )
    start = S.extract_after(text, "START WITH", (F.col("o_orderkey"), F.col("o_custkey")))
    return t("orders").select("o_orderkey", start.alias("start"))


@R.add(
    "f09_strip_suffix_lower",
    "SELECT p_partkey, CASE WHEN p_size > 20 THEN lower(p_type) ELSE lower(p_brand) || ' x' END AS name FROM part",
)
def _(t):
    text = F.when(F.col("p_size") > 20, F.concat("p_type", F.lit("  LINK"))).otherwise(F.concat("p_brand", F.lit(" x")))
    return t("part").select("p_partkey", S.strip_suffix_lower(text, r"\s+LINK").alias("name"))


@R.add(
    "f10_decode_flags",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' END AS returned,
    CASE WHEN l_returnflag <> 'R' THEN '' ELSE CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' END END AS status FROM lineitem""",
)
def _(t):
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        S.decode_flags("l_returnflag", {"A": "accepted", "R": "returned"}).alias("returned"),
        S.decode_flags("l_linestatus", {"O": "open", "F": "final"}, F.col("l_returnflag") == "R").alias("status"),
    )


@R.add(
    "f11_major_version",
    """SELECT p_partkey, CASE p_size WHEN 12 THEN '12c' WHEN 18 THEN '18c' WHEN 19 THEN '19c' WHEN 23 THEN '23ai'
    WHEN 1 THEN '12c' WHEN 2 THEN '21c' ELSE '21c' END AS version FROM part""",
)
def _(t):
    # The known versions and the default.
    known, default = ["12c", "18c", "19c", "21c", "23ai"], "21c"
    dotted = F.concat(F.col("p_size").cast("string"), F.lit(".3.0.0"))
    return t("part").select("p_partkey", S.major_version(dotted, known, default).alias("version"))


@R.add("f12_bytes_to_text", "SELECT doc_id, md5(text) AS digest, FALSE AS broken FROM documents")
def _(t):
    bad = F.contains(S.bytes_to_text(F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))), F.lit("�"))
    return t("documents").select("doc_id", F.md5(S.bytes_to_text(F.encode("text", "UTF-8"))).alias("digest"), (~bad).alias("broken"))


@R.add(
    "f13_drop_nulls",
    """SELECT d.doc_id, 'lang' || CASE WHEN quality IS NULL THEN '' ELSE ',quality' END || CASE WHEN toxic IS NULL THEN '' ELSE ',toxic' END AS keys
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(t):
    docs = t("documents").join(t("labels"), "doc_id", "left")
    names = ["lang", "quality", "toxic"]
    record = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    return docs.select("doc_id", F.array_join(F.map_keys(S.drop_nulls(record)), ",").alias("keys"))


_KINDS = """CASE event_type WHEN 'click' THEN 'object' WHEN 'error' THEN 'array' WHEN 'purchase' THEN 'number' WHEN 'signup' THEN NULL ELSE 'boolean' END"""


@R.add("f14_json_kind", f"SELECT event_id, {_KINDS} AS kind FROM events")
def _(t):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.col("props"))
        .when(kind == "error", F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == "purchase", F.col("value").cast("string"))
        .when(kind == "signup", F.substring("props", 1, 4))
        .otherwise((F.col("value") > 100).cast("string"))
    )
    return t("events").select("event_id", S.json_kind(text).alias("kind"))


@R.add(
    "f15_number_or_null",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS DOUBLE) WHEN 'O' THEN NULL ELSE CAST(o_custkey * 1000 AS DOUBLE) END AS number FROM orders""",
)
def _(t):
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), "o_custkey"))
        .when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") > 700), "")
        .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .otherwise(F.concat("o_custkey", F.lit("e3")))
    )
    return t("orders").select("o_orderkey", S.number_or_null(text).alias("number"))


@R.add(
    "f16_strip_outer_parens",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a > (' || o_custkey || ')' WHEN 'O' THEN '(a) or (' || o_custkey || ')' ELSE CAST(o_custkey AS VARCHAR) END AS text FROM orders""",
)
def _(t):
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" (a > ("), "o_custkey", F.lit("))")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("(a) or ("), "o_custkey", F.lit(") ")))
        .otherwise(F.concat(F.lit("("), "o_custkey", F.lit(")")))
    )
    return t("orders").select("o_orderkey", S.strip_outer_parens(text).alias("text"))


@R.add(
    "f17_split_statements",
    """WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
    q AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, l FROM p),
    s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, l[i] AS part FROM q WHERE trim(l[i] || ';') <> ';' OR i < len(l))
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, md5(trim(part, ' /;' || chr(9) || chr(10) || chr(13))) AS statement FROM s""",
)
def _(t):
    # every line becomes a statement of its own
    script = F.replace(F.col("text"), F.lit("\n"), F.lit(";\n/\n\n"))
    parts = t("documents").select("doc_id", F.explode(S.split_statements(script)).alias("s"))
    return parts.select("doc_id", "s.pos", F.md5("s.statement").alias("statement"))


@R.add("f18_headline", "SELECT doc_id, substring(string_split(text, chr(10))[1], 1, 150) AS line FROM documents")
def _(t):
    return t("documents").select("doc_id", S.headline("text").alias("line"))


@R.add(
    "f19_parse_time",
    """SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS sec, date_trunc('millisecond', ts) AS milli, ts AS micro,
    epoch_ms(date_trunc('millisecond', ts)) - 7200000 AS zoned, TRUE AS refused FROM events""",
)
def _(t):
    def text(pattern: str):
        return F.date_format("ts", pattern)

    return t("events").select(
        "event_id",
        S.parse_time(text("yyyy-MM-dd"), "date").alias("day"),
        S.parse_time(text("yyyy-MM-dd HH:mm:ss")).alias("sec"),
        S.parse_time(text("yyyy-MM-dd HH:mm:ss.SSS"), frac=3).alias("milli"),
        S.parse_time(F.concat(text("yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000")), frac=9).alias("micro"),
        F.unix_millis(S.parse_time(F.concat(text("yyyy-MM-dd HH:mm:ss.SSS"), F.lit("+0200")), frac=3, tz=True)).alias("zoned"),
        S.parse_time(text("yyyy/MM/dd"), "date").isNull().alias("refused"),
    )


@R.add(
    "f20_rename_keys",
    "SELECT p_partkey, CASE WHEN p_size > 30 THEN p_brand WHEN p_size > 10 THEN p_type ELSE p_name END AS label FROM part",
)
def _(t):
    code = F.when(F.col("p_size") > 30, F.col("p_brand")).otherwise("")
    name = F.when(F.col("p_size") > 10, F.col("p_type"))
    return t("part").select("p_partkey", S.rename_keys(code, name, "p_name").alias("label"))
