"""Scalar functions over the given tables."""

import time

from pyspark.sql import functions as F

from veritab.catalog.registry import query
from veritab.functions import collections as C
from veritab.functions import conversion as V
from veritab.functions import dates as D
from veritab.functions import numbers as N
from veritab.functions import strings as S

_DAY = "yyyy-MM-dd"
_TS = "yyyy-MM-dd HH:mm:ss"


def _text(c, fmt=_TS):
    return F.date_format(c, fmt)


# Conversion


@query(
    "F1_casts",
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, CAST(o_totalprice AS DECIMAL(12,1)) AS dec, CAST(o_orderkey AS DOUBLE) AS dbl,
         CAST(o_custkey AS DECIMAL(38,0)) AS num, CAST(o_orderkey AS VARCHAR) AS txt, strftime(CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts FROM orders""",
)
def casts(read):
    day = F.col("o_orderdate")
    return read("orders").select(
        "o_orderkey",
        day.cast("date").cast("string").alias("d"),
        F.col("o_totalprice").cast("decimal(12,1)").alias("dec"),
        F.col("o_orderkey").cast("double").alias("dbl"),
        F.col("o_custkey").cast("decimal(38,0)").alias("num"),
        F.col("o_orderkey").cast("string").alias("txt"),
        _text(_text(day, _DAY).cast("timestamp")).alias("ts"),
    )


@query(
    "F2_try_cast",
    """SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS n, TRY_CAST(p_name AS INTEGER) AS bad FROM part""",
)
def try_cast(read):
    number = F.replace("p_brand", F.lit("Brand#"), F.lit(""))
    return read("part").select("p_partkey", number.try_cast("int").alias("n"), F.col("p_name").try_cast("int").alias("bad"))


@query(
    "F3_to_number",
    """SELECT c_custkey, CAST(c_custkey AS DECIMAL(38,0)) AS whole, CAST(replace(format('{:,}', c_custkey * 1000 + 7), ',', '') AS DECIMAL(12,2)) AS grouped FROM customer""",
)
def to_number(read):
    text = F.format_string("%,d", F.col("c_custkey") * 1000 + 7)
    return read("customer").select(
        "c_custkey",
        V.to_number(F.col("c_custkey").cast("string")).alias("whole"),
        V.to_number(text, "999,999,999", 12, 2).alias("grouped"),
    )


@query(
    "F4_try_to_number",
    """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DECIMAL(38,0)) AS n, CAST(NULL AS DECIMAL(10,1)) AS none,
       CAST(split_part(p_brand, '#', 2) AS DECIMAL(10,1)) AS fmt FROM part""",
)
def try_to_number(read):
    number = F.split_part("p_brand", F.lit("#"), F.lit(2))
    return read("part").select(
        "p_partkey",
        V.try_to_number(number).alias("n"),
        V.try_to_number(F.col("p_name"), "999", 10, 1).alias("none"),
        V.try_to_number(number, "999", 10, 1).alias("fmt"),
    )


@query(
    "F5_to_boolean",
    """SELECT p_partkey, p_partkey % 6 IN (0, 2, 4) AS word, p_size % 3 <> 0 AS number, CASE WHEN p_partkey % 2 = 0 THEN true END AS tried FROM part""",
)
def to_boolean(read):
    words = F.array(*[F.lit(w) for w in ("yes", "No", "T", "off", "1", "false")])
    key = F.col("p_partkey")
    word = F.get(words, (key % 6).cast("int"))
    return read("part").select(
        "p_partkey",
        V.text_to_boolean(word).alias("word"),
        V.number_to_boolean(F.col("p_size") % 3).alias("number"),
        V.text_to_boolean(F.when(key % 2 == 0, "ON").otherwise(F.col("p_name")), strict=False).alias("tried"),
    )


@query(
    "F6_try_to_date",
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, CAST(NULL AS VARCHAR) AS bad, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS fmt FROM orders""",
)
def try_to_date(read):
    day = F.col("o_orderdate")
    return read("orders").select(
        "o_orderkey",
        V.try_to_date(_text(day, _DAY)).cast("string").alias("d"),
        V.try_to_date(F.col("o_orderstatus")).cast("string").alias("bad"),
        V.try_to_date(_text(day, "dd/MM/yyyy"), "dd/MM/yyyy").cast("string").alias("fmt"),
    )


@query(
    "F7_to_timestamp",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS a, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS b,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS c, strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(extract('ms' FROM ts) % 1000 AS VARCHAR), 3, '0') AS ms FROM events""",
)
def to_timestamp(read):
    ts = F.col("ts").cast("timestamp")
    odd = F.col("event_id") % 2 == 1
    fmt = F.when(odd, "dd.MM.yyyy HH:mm:ss").otherwise(_TS)
    text = F.when(odd, F.date_format(ts, "dd.MM.yyyy HH:mm:ss")).otherwise(F.date_format(ts, _TS))
    return read("events").select(
        "event_id",
        _text(V.to_timestamp_any(F.date_format(ts, _TS))).alias("a"),
        _text(V.to_timestamp_any(text, fmt)).alias("b"),
        _text(V.to_timestamp_any(F.unix_timestamp(ts), scale=0)).alias("c"),
        _text(V.to_timestamp_any(F.unix_millis(ts), scale=3), _TS + ".SSS").alias("ms"),
    )


@query("F8_to_time", "SELECT event_id, strftime(ts, '%H:%M:%S') AS t FROM events")
def to_time(read):
    return read("events").select("event_id", V.to_time(F.col("ts")).alias("t"))


@query("F9_to_char", "SELECT o_orderkey, lpad(format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE), 12, ' ') AS t FROM orders")
def to_char(read):
    money = F.col("o_totalprice").cast("decimal(18,2)")
    return read("orders").select("o_orderkey", F.lpad(F.trim(F.to_char(money, F.lit("9,999,999.99"))), 12, " ").alias("t"))


@query(
    "F10_to_double_json",
    """SELECT n_nationkey, CAST(CAST(n_nationkey AS VARCHAR) AS DOUBLE) AS d, '{"n":"' || n_name || '","r":' || n_regionkey || '}' AS j, n_name AS v FROM nation""",
)
def to_double_json(read):
    packed = F.struct(F.col("n_name").alias("n"), F.col("n_regionkey").alias("r"))
    variant = F.to_variant_object(packed)
    return read("nation").select(
        "n_nationkey",
        F.col("n_nationkey").cast("string").cast("double").alias("d"),
        F.to_json(packed).alias("j"),
        F.variant_get(variant, "$.n", "string").alias("v"),
    )


@query("F11_to_array", "SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN 1 END AS n, CASE WHEN p_size % 4 <> 0 THEN p_name END AS first FROM part")
def to_array(read):
    a = V.to_array(F.when(F.col("p_size") % 4 != 0, F.col("p_name")))
    return read("part").select("p_partkey", F.when(a.isNotNull(), F.size(a)).alias("n"), F.get(a, F.lit(0)).alias("first"))


@query(
    "F12_is_integer",
    """SELECT p_partkey, true AS yes, false AS no, CASE WHEN p_size % 5 <> 0 THEN p_partkey % 2 = 0 END AS mixed FROM part""",
)
def is_integer(read):
    key = F.col("p_partkey").cast("string")
    mixed = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("-"), key)).otherwise(F.concat(key, F.lit("99999999999")))
    return read("part").select(
        "p_partkey",
        V.is_integer(key).alias("yes"),
        V.is_integer(F.col("p_name")).alias("no"),
        V.is_integer(F.when(F.col("p_size") % 5 != 0, mixed)).alias("mixed"),
    )


@query("F13_typeof", "SELECT o_orderkey, 'bigint' AS a, 'double' AS b, 'string' AS c FROM orders")
def type_of(read):
    return read("orders").select(
        "o_orderkey", F.typeof("o_orderkey").alias("a"), F.typeof("o_totalprice").alias("b"), F.typeof("o_orderstatus").alias("c")
    )


# Null and conditional

_N = "NULLIF(p_size % 7, 0)"


def _n():
    return F.nullif(F.col("p_size") % 7, F.lit(0))


@query("F14_coalesce", f"SELECT p_partkey, COALESCE({_N}, -1) AS a, COALESCE({_N}, p_size) AS b, COALESCE({_N}, 5) AS c FROM part")
def coalesce(read):
    return read("part").select(
        "p_partkey",
        F.coalesce(_n(), F.lit(-1)).alias("a"),
        F.nvl(_n(), F.col("p_size")).alias("b"),
        F.ifnull(_n(), F.lit(5)).alias("c"),
    )


@query(
    "F15_nvl2",
    f"SELECT p_partkey, CASE WHEN {_N} IS NOT NULL THEN p_size ELSE -p_size END AS a, NULLIF(p_size, 10) AS b, {_N} IS NOT DISTINCT FROM NULLIF(p_size % 5, 0) AS c FROM part",
)
def nvl2(read):
    return read("part").select(
        "p_partkey",
        F.nvl2(_n(), F.col("p_size"), -F.col("p_size")).alias("a"),
        F.nullif(F.col("p_size"), F.lit(10)).alias("b"),
        F.equal_null(_n(), F.nullif(F.col("p_size") % 5, F.lit(0))).alias("c"),
    )


@query("F16_zero_null", f"SELECT p_partkey, COALESCE({_N}, 0) AS a, NULLIF(p_size % 7, 0) AS b FROM part")
def zero_null(read):
    return read("part").select("p_partkey", F.zeroifnull(_n()).alias("a"), F.nullifzero(F.col("p_size") % 7).alias("b"))


@query(
    "F17_if_decode",
    f"""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' END AS a, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS b,
         CASE WHEN {_N} IS NULL THEN 'none' WHEN {_N} = 1 THEN 'one' ELSE 'more' END AS c FROM part""",
)
def if_decode(read):
    big = F.col("p_size") > 25
    p = read("part").withColumn("n", _n())
    return p.select(
        "p_partkey",
        F.when(big, "big").alias("a"),
        F.when(big, 1).otherwise(0).alias("b"),
        F.expr("decode(n, null, 'none', 1, 'one', 'more')").alias("c"),
    )


@query("F18_greatest", f"SELECT p_partkey, GREATEST(p_size, {_N}, 20) AS a, LEAST(p_size, {_N}, 20) AS b FROM part")
def greatest(read):
    return read("part").select(
        "p_partkey", F.greatest("p_size", _n(), F.lit(20)).alias("a"), F.least("p_size", _n(), F.lit(20)).alias("b")
    )


# Math and bits


@query(
    "F19_arithmetic",
    """SELECT c_custkey, ABS(c_acctbal) AS a, CAST(CEIL(c_acctbal) AS BIGINT) AS c, CAST(FLOOR(c_acctbal) AS BIGINT) AS f, CAST(ROUND(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS r,
         CAST(SIGN(c_acctbal) AS DOUBLE) AS s, ROUND(SQRT(ABS(c_acctbal)), 9) AS q, ROUND(EXP(c_nationkey / 10.0), 9) AS e, ROUND(LN(c_custkey + 1), 9) AS l,
         ROUND(LOG10(c_custkey + 1), 9) AS g, c_custkey % 7 AS m, ROUND(PI(), 9) AS p FROM customer""",
)
def arithmetic(read):
    b, one = F.col("c_acctbal"), F.col("c_custkey") + 1
    return read("customer").select(
        "c_custkey",
        F.abs(b).alias("a"),
        F.ceil(b).alias("c"),
        F.floor(b).alias("f"),
        F.round(b.cast("decimal(18,2)"), 1).cast("double").alias("r"),
        F.sign(b).alias("s"),
        F.round(F.sqrt(F.abs(b)), 9).alias("q"),
        F.round(F.exp(F.col("c_nationkey") / 10), 9).alias("e"),
        F.round(F.ln(one), 9).alias("l"),
        F.round(F.log10(one), 9).alias("g"),
        (F.col("c_custkey") % 7).alias("m"),
        F.round(F.pi(), 9).alias("p"),
    )


@query(
    "F20_trigonometry",
    """SELECT p_partkey, ROUND(SIN(p_size), 9) AS s, ROUND(COS(p_size), 9) AS c, ROUND(TAN(p_size), 6) AS t, ROUND(ASIN(p_size / 100.0), 9) AS a,
         ROUND(ATAN2(p_size, 3), 9) AS b, ROUND(RADIANS(p_size), 9) AS r FROM part""",
)
def trigonometry(read):
    x = F.col("p_size")
    return read("part").select(
        "p_partkey",
        F.round(F.sin(x), 9).alias("s"),
        F.round(F.cos(x), 9).alias("c"),
        F.round(F.tan(x), 6).alias("t"),
        F.round(F.asin(x / 100), 9).alias("a"),
        F.round(F.atan2(x, F.lit(3)), 9).alias("b"),
        F.round(F.radians(x), 9).alias("r"),
    )


@query("F21_square", "SELECT p_partkey, CAST(p_size * p_size AS DOUBLE) AS s FROM part")
def square(read):
    return read("part").select("p_partkey", N.square(F.col("p_size")).alias("s"))


@query("F21_random", "SELECT p_partkey, true AS inside, true AS same_seed, COUNT(*) OVER () > 1 AS differs FROM part")
def random(read):
    """From 0 up to but without 1; a seed fixes the values; rows differ."""
    drawn = read("part").select("p_partkey", F.rand(42).alias("a"), F.rand(42).alias("b"), F.rand().alias("c"))
    several = F.count_distinct("c") > 1
    return drawn.join(drawn.agg(several.alias("differs"))).select(
        "p_partkey", (F.col("a").between(0, 0.9999999999999999) & F.col("c").between(0, 0.9999999999999999)).alias("inside"), (F.col("a") == F.col("b")).alias("same_seed"), "differs"
    )


@query(
    "F22_div0",
    f"""SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 0.0 ELSE p_retailprice / (p_size % 7) END AS z,
         CASE WHEN {_N} IS NULL OR {_N} = 0 THEN 0.0 ELSE p_retailprice / {_N} END AS n FROM part""",
)
def div0(read):
    price = F.col("p_retailprice")
    return read("part").select(
        "p_partkey", N.div0(price, F.col("p_size") % 7).alias("z"), N.div0null(price, _n()).alias("n")
    )


@query(
    "F23_bits",
    """SELECT o_orderkey, CAST(bit_count(o_orderkey) AS INTEGER) AS c, CAST((o_orderkey >> 3) & 1 AS INTEGER) AS g, o_orderkey | 128 AS s, o_orderkey << 2 AS l, o_orderkey >> 2 AS r FROM orders""",
)
def bits(read):
    k = F.col("o_orderkey")
    return read("orders").select(
        "o_orderkey",
        F.bit_count(k).alias("c"),
        F.getbit(k, F.lit(3)).cast("int").alias("g"),
        N.set_bit(k, 7).alias("s"),
        F.shiftleft(k, 2).alias("l"),
        F.shiftright(k, 2).alias("r"),
    )


@query("F24_hashes", "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer")
def hashes(read):
    return read("customer").select("c_custkey", F.md5("c_name").alias("m"), N.sha2(F.col("c_name")).alias("s"))


@query(
    "F24_hash_and_uuid",
    """SELECT c_custkey, true AS same_hash, true AS free_uuid,
         CAST(s[1:8] || '-' || s[9:12] || '-5' || s[14:16] || '-' || lower(to_hex((CAST('0x' || s[17:18] AS BIGINT) & 63) | 128)) || s[19:20] || '-' || s[21:32] AS VARCHAR) AS named
       FROM (SELECT c_custkey, sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_name)) AS s FROM customer)""",
)
def hash_and_uuid(read):
    """Equal texts have equal hashes, free ids have the form of version 4, named ids follow from the name."""
    form = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return read("customer").select(
        "c_custkey", (F.hash("c_name") == F.hash(F.concat("c_name", F.lit("")))).alias("same_hash"), F.expr("uuid()").rlike(form).alias("free_uuid"),
        N.uuid_from_name("6ba7b810-9dad-11d1-80b4-00c04fd430c8", F.col("c_name")).alias("named"),
    )


# Strings


@query(
    "F25_text",
    """SELECT p_partkey, LOWER(p_brand) AS a, UPPER(p_name) AS b, upper(p_type[1]) || lower(p_type[2:]) AS c, TRIM('  ' || p_name || ' ') AS d,
         LTRIM('  ' || p_name) AS e, RTRIM(p_name || '  ') AS f, LPAD(p_type, 12, '*') AS g, RPAD(p_type, 12, '*') AS h, LEFT(p_name, 4) AS i, RIGHT(p_name, 3) AS j,
         REVERSE(p_name) AS k, REPEAT(p_type, 2) AS l, REPLACE(p_name, 'e', 'EE') AS m, TRANSLATE(p_name, 'aeiou', '12345') AS n FROM part""",
)
def text(read):
    name, kind = F.col("p_name"), F.col("p_type")
    return read("part").select(
        "p_partkey",
        F.lower("p_brand").alias("a"),
        F.upper(name).alias("b"),
        F.initcap(kind).alias("c"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("d"),
        F.ltrim(F.concat(F.lit("  "), name)).alias("e"),
        F.rtrim(F.concat(name, F.lit("  "))).alias("f"),
        F.lpad(kind, 12, "*").alias("g"),
        F.rpad(kind, 12, "*").alias("h"),
        F.left(name, F.lit(4)).alias("i"),
        F.right(name, F.lit(3)).alias("j"),
        F.reverse(name).alias("k"),
        F.repeat(kind, 2).alias("l"),
        F.replace(name, F.lit("e"), F.lit("EE")).alias("m"),
        F.translate(name, "aeiou", "12345").alias("n"),
    )


@query(
    "F26_contains",
    """SELECT p_partkey, starts_with(p_name, 's') AS a, ends_with(p_name, 'g') AS b, contains(p_name, 'ri') AS c, concat_ws('-', p_name, p_brand, p_type) AS d FROM part""",
)
def contains(read):
    name = F.col("p_name")
    return read("part").select(
        "p_partkey",
        name.startswith("s").alias("a"),
        name.endswith("g").alias("b"),
        name.contains("ri").alias("c"),
        F.concat_ws("-", "p_name", "p_brand", "p_type").alias("d"),
    )


@query(
    "F27_position",
    """SELECT doc_id, CAST(strpos(text, 'e') AS INTEGER) AS a, CAST(CASE WHEN strpos(text[5:], 'e') > 0 THEN strpos(text[5:], 'e') + 4 ELSE 0 END AS INTEGER) AS b,
         CAST(CASE WHEN strpos(text, 'e') = 0 OR strpos(text[strpos(text, 'e') + 1:], 'e') = 0 THEN 0 ELSE strpos(text, 'e') + strpos(text[strpos(text, 'e') + 1:], 'e') END AS INTEGER) AS c
       FROM documents""",
)
def position(read):
    t, e = F.col("text"), F.lit("e")
    return read("documents").select(
        "doc_id", S.charindex(e, t).alias("a"), S.charindex(e, t, 5).alias("b"), S.strpos(t, e, 2).alias("c")
    )


@query(
    "F28_split_part",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', CASE WHEN p_size % 3 = 0 THEN 1 ELSE p_size % 3 END) AS b FROM part""",
)
def split_part(read):
    return read("part").select(
        "p_partkey",
        S.split_part(F.col("p_name"), F.lit(" "), F.lit(0)).alias("a"),
        S.split_part(F.col("p_name"), F.lit(" "), F.col("p_size") % 3).alias("b"),
    )


@query(
    "F29_strtok",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_brand, '#', 2) AS b, array_to_string(string_split_regex(p_brand || '.' || p_name, '[.# ]'), '|') AS c FROM part""",
)
def strtok(read):
    joined = F.concat("p_brand", F.lit("."), "p_name")
    return read("part").select(
        "p_partkey",
        S.strtok(F.col("p_name")).alias("a"),
        S.strtok(F.col("p_brand"), "#", 2).alias("b"),
        F.array_join(S.strtok_to_array(joined, ".# "), "|").alias("c"),
    )


@query(
    "F30_regexp",
    """SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS a, CAST(len(regexp_extract_all(text, '[aeiou]+')) AS INTEGER) AS b, regexp_replace(text, '[0-9]+', '#', 'g') AS c,
         CAST(CASE WHEN regexp_matches(text, '[A-Z][a-z]+') THEN length(regexp_extract(text, '^(?s:(.*?))[A-Z][a-z]+', 1)) + 1 ELSE 0 END AS INTEGER) AS d FROM documents""",
)
def regexp(read):
    return read("documents").select(
        "doc_id",
        F.rlike("text", F.lit("[0-9]{3}")).alias("a"),
        F.regexp_count("text", F.lit("[aeiou]+")).alias("b"),
        F.regexp_replace("text", "[0-9]+", "#").alias("c"),
        F.regexp_instr("text", F.lit("[A-Z][a-z]+")).alias("d"),
    )


@query(
    "F31_regexp_substr",
    """SELECT p_partkey, nullif(regexp_extract(p_name, '[a-z]+'), '') AS a, list_extract(regexp_extract_all(p_name, '[a-z]+'), 2) AS b,
         list_extract(regexp_extract_all(p_brand, '(?i)BRAND#([0-9]+)', 1), 1) AS c, list_extract(regexp_extract_all(p_name[3:], '[a-z]+'), 1) AS d FROM part""",
)
def regexp_substr(read):
    name = F.col("p_name")
    return read("part").select(
        "p_partkey",
        S.regexp_substr(name, "[a-z]+").alias("a"),
        S.regexp_substr(name, "[a-z]+", 1, 2).alias("b"),
        S.regexp_substr(F.col("p_brand"), "BRAND#([0-9]+)", 1, 1, "ie").alias("c"),
        S.regexp_substr(name, "[a-z]+", 3).alias("d"),
    )


@query(
    "F32_edit_distance",
    """SELECT p_partkey, CAST(levenshtein(p_name, p_type) AS INTEGER) AS a, CAST(CASE WHEN levenshtein(p_name, p_type) <= 8 THEN levenshtein(p_name, p_type) ELSE -1 END AS INTEGER) AS b FROM part""",
)
def edit_distance(read):
    return read("part").select(
        "p_partkey", F.levenshtein("p_name", "p_type").alias("a"), F.levenshtein("p_name", "p_type", 8).alias("b")
    )


@query(
    "F33_base64_url",
    """SELECT page_id, to_base64(encode(url)) AS b, url AS back, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
         nullif(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '') AS path FROM pages""",
)
def base64_url(read):
    url = F.col("url")
    return read("pages").select(
        "page_id",
        S.base64_encode(url).alias("b"),
        S.base64_decode(S.base64_encode(url)).alias("back"),
        F.parse_url(url, F.lit("HOST")).alias("host"),
        F.nullif(F.parse_url(url, F.lit("PATH")), F.lit("")).alias("path"),
    )


@query(
    "F34_collation",
    """SELECT c_custkey, lower(c_mktsegment) = 'building' AS same, 'SYSTEM.BUILTIN.UTF8_LCASE' AS name FROM customer""",
)
def collation(read):
    folded = F.collate("c_mktsegment", "UTF8_LCASE")
    return read("customer").select(
        "c_custkey", (folded == F.lit("building")).alias("same"), F.collation(folded).alias("name")
    )


@query(
    "F35_length_and_quote",
    """SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS a, repeat(p_type, 3) AS b, chr(65 + p_size % 26) AS c, '''' || replace(p_name || '''s', '''', '''''') || '''' AS d,
         replace(p_name, ' ', '_') AS e FROM part""",
)
def length_and_quote(read):
    return read("part").select(
        "p_partkey",
        F.char_length("p_name").alias("a"),
        F.repeat("p_type", 3).alias("b"),
        F.chr(65 + F.col("p_size") % 26).alias("c"),
        S.quote_literal(F.concat("p_name", F.lit("'s"))).alias("d"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("e"),
    )


# Date and time


@query(
    "F36_timestamp_add",
    """SELECT event_id, strftime(ts + INTERVAL 2 YEAR, '%Y-%m-%d %H:%M:%S') AS a, strftime(ts + INTERVAL 9 MONTH, '%Y-%m-%d %H:%M:%S') AS b, strftime(ts + INTERVAL 14 DAY, '%Y-%m-%d %H:%M:%S') AS c,
         strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS d, strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS e FROM events""",
)
def timestamp_add(read):
    ts = F.col("ts")
    return read("events").select(
        "event_id",
        _text(D.timestamp_add("yy", 2, ts)).alias("a"),
        _text(D.timestamp_add("qtr", 3, ts)).alias("b"),
        _text(D.timestamp_add("wk", 2, ts)).alias("c"),
        _text(D.timestamp_add("hh", -5, ts)).alias("d"),
        _text(D.timestamp_add("mi", 90, ts)).alias("e"),
    )


@query(
    "F37_date_add",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS a, strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d') AS b, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS c,
         strftime(o_orderdate + INTERVAL 6 MONTH, '%Y-%m-%d') AS d, strftime(o_orderdate + INTERVAL 24 MONTH, '%Y-%m-%d') AS e, strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS f,
         strftime(o_orderdate + INTERVAL 45 SECOND, '%Y-%m-%d %H:%M:%S') AS g, strftime(o_orderdate + INTERVAL 1500 MILLISECOND, '%Y-%m-%d %H:%M:%S') AS h,
         strftime(o_orderdate + INTERVAL 13 HOUR + INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') AS i, strftime(o_orderdate + INTERVAL 13 HOUR + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS j,
         epoch_us(o_orderdate + INTERVAL 7 MICROSECOND) AS k FROM orders""",
)
def date_add(read):
    day, ts = F.col("o_orderdate").cast("date"), F.col("o_orderdate")
    cells = {
        "a": D.date_add("weekday", 2, day).cast("string"),
        "b": D.date_add("week", 2, day).cast("string"),
        "c": D.date_add("month", 1, day).cast("string"),
        "d": D.date_add("quarter", 2, day).cast("string"),
        "e": D.date_add("year", 2, day).cast("string"),
        "f": _text(D.date_add("hour", 7, ts)),
        "g": _text(D.date_add("second", 45, ts)),
        "h": _text(D.date_add("millisecond", 1500, ts)),
        "i": _text(D.date_add("day", 3, D.date_add("hour", 13, ts))),
        "j": _text(D.date_add("month", 1, D.date_add("hour", 13, ts))),
        "k": F.unix_micros(D.date_add("nanosecond", 7999, ts.cast("timestamp"))),
    }
    return read("orders").select("o_orderkey", *[c.alias(n) for n, c in cells.items()])


@query(
    "F38_date_diff",
    """SELECT event_id, CAST(date_diff('year', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS y, CAST(date_diff('quarter', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS q,
         CAST(date_diff('month', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS m, CAST(date_diff('day', DATE '2019-12-30', date_trunc('week', ts)::DATE) // 7 AS BIGINT) AS w,
         CAST(date_diff('day', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS d, CAST(date_diff('hour', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS h,
         CAST(date_diff('second', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS s, CAST(date_sub('month', TIMESTAMP '2019-12-31 12:34:56', ts) AS BIGINT) AS whole FROM events""",
)
def date_diff(read):
    start, end = F.lit("2019-12-31 12:34:56").cast("timestamp_ntz"), F.col("ts")
    units = {"y": "year", "q": "quarter", "m": "month", "w": "week", "d": "day", "h": "hour", "s": "second"}
    cells = [D.date_diff(u, start, end).cast("long").alias(n) for n, u in units.items()]
    whole = D.date_diff("month", start, end, whole=True).cast("long").alias("whole")
    return read("events").select("event_id", *cells, whole)


@query(
    "F39_month_helpers",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 5 MONTH, '%Y-%m-%d') AS a, strftime(last_day(o_orderdate), '%Y-%m-%d') AS b,
         strftime(CAST(o_orderdate AS DATE) + CAST((7 - (isodow(o_orderdate) - 5)) % 7 + CASE WHEN (7 - (isodow(o_orderdate) - 5)) % 7 = 0 THEN 7 ELSE 0 END AS INTEGER), '%Y-%m-%d') AS c FROM orders""",
)
def month_helpers(read):
    day = F.col("o_orderdate").cast("date")
    return read("orders").select(
        "o_orderkey",
        F.add_months(day, 5).cast("string").alias("a"),
        F.last_day(day).cast("string").alias("b"),
        F.next_day(day, "Fri").cast("string").alias("c"),
    )


@query(
    "F40_last_day",
    """SELECT o_orderkey, strftime(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY, '%Y-%m-%d') AS y,
         strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS q,
         strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS m,
         strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS w FROM orders""",
)
def last_day(read):
    day = F.col("o_orderdate").cast("date")
    units = {"y": "YEAR", "q": "QUARTER", "m": "MONTH", "w": "WEEK"}
    return read("orders").select("o_orderkey", *[D.last_day(day, u).cast("string").alias(n) for n, u in units.items()])


@query(
    "F41_date_trunc",
    """SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS a, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS b, strftime(date_trunc('year', ts), '%Y-%m-%d') AS c FROM events""",
)
def date_trunc(read):
    ts = F.col("ts")
    return read("events").select(
        "event_id",
        _text(F.date_trunc("month", ts), _DAY).alias("a"),
        _text(F.date_trunc("hour", ts)).alias("b"),
        F.trunc(ts.cast("date"), "year").cast("string").alias("c"),
    )


@query(
    "F42_date_part",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(month(ts) AS INTEGER) AS m, CAST(weekofyear(ts) AS INTEGER) AS w, CAST(day(ts) AS INTEGER) AS d,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS mi, CAST(second(ts) AS INTEGER) AS s,
         CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events""",
)
def date_part(read):
    ts = F.col("ts")
    parts = {
        "y": F.year(ts), "q": F.quarter(ts), "m": F.month(ts), "w": F.weekofyear(ts), "d": F.dayofmonth(ts), "dow": F.dayofweek(ts),
        "doy": F.dayofyear(ts), "h": F.hour(ts), "mi": F.minute(ts), "s": F.extract(F.lit("SECOND"), ts).cast("int"),
        "e": F.unix_timestamp(ts.cast("timestamp")),
    }
    return read("events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("F43_names", "SELECT o_orderkey, left(dayname(o_orderdate), 3) AS d, left(monthname(o_orderdate), 3) AS m FROM orders")
def names(read):
    day = F.col("o_orderdate")
    return read("orders").select("o_orderkey", D.day_name(day).alias("d"), D.month_name(day).alias("m"))


@query("F44_format_datetime", "SELECT event_id, strftime(ts, '%d/%m/%Y %H.%M') AS t FROM events")
def format_datetime(read):
    return read("events").select("event_id", F.date_format("ts", "dd/MM/yyyy HH.mm").alias("t"))


@query(
    "F45_from_parts",
    """SELECT p_partkey, strftime(make_date(CAST(2000 + p_size % 20 AS BIGINT), CAST(1 + p_size % 12 AS BIGINT), CAST(1 + p_size % 28 AS BIGINT)), '%Y-%m-%d') AS d,
         strftime(make_timestamp(CAST(2000 + p_size % 20 AS BIGINT), CAST(1 + p_size % 12 AS BIGINT), CAST(1 + p_size % 28 AS BIGINT), CAST(p_size % 24 AS BIGINT), CAST(p_size AS BIGINT), 7.0), '%Y-%m-%d %H:%M:%S') AS t FROM part""",
)
def from_parts(read):
    n = F.col("p_size")
    y, m, d = 2000 + n % 20, 1 + n % 12, 1 + n % 28
    return read("part").select(
        "p_partkey",
        F.make_date(y, m, d).cast("string").alias("d"),
        _text(F.make_timestamp(y, m, d, n % 24, n, F.lit(7))).alias("t"),
    )


@query(
    "F46_convert_timezone",
    """SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS a, strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS b FROM events""",
)
def convert_timezone(read):
    ts = F.col("ts")
    return read("events").select(
        "event_id",
        _text(D.convert_timezone("Asia/Tokyo", ts, "UTC")).alias("a"),
        _text(D.convert_timezone("UTC", ts, "Asia/Kolkata")).alias("b"),
    )


@query("F47_current_time", "SELECT n_nationkey, true AS now, true AS today, true AS time FROM nation")
def current_time(read):
    """The clock of the query: after the data were written, and date and time of one moment."""
    ts = F.current_timestamp()
    return read("nation").select(
        "n_nationkey",
        (F.abs(F.unix_timestamp(ts) - F.lit(int(time.time()))) < 3600).alias("now"),
        (F.current_date() == F.to_date(ts)).alias("today"),
        F.date_format(ts, "HH:mm:ss").rlike("^[0-2][0-9]:[0-5][0-9]:[0-5][0-9]$").alias("time"),
    )


# Arrays, maps, structs, JSON

_WORDS = "string_split(p_name || ' ' || p_type, ' ')"


def _words():
    return F.split(F.concat_ws(" ", "p_name", "p_type"), " ")


@query(
    "F48_arrays",
    f"""SELECT p_partkey, array_to_string(list_append({_WORDS}, 'x'), ',') AS a, array_to_string(list_prepend('x', {_WORDS}), ',') AS b, array_to_string({_WORDS} || ['y', 'z'], ',') AS c,
         array_to_string(list_sort(list_distinct({_WORDS} || {_WORDS})), ',') AS d, array_to_string(list_filter({_WORDS}, lambda w: w <> 'red'), ',') AS e, list_contains({_WORDS}, 'red') AS f,
         CAST(coalesce(list_position({_WORDS}, 'red'), 0) AS BIGINT) AS g, CAST(len({_WORDS}) AS INTEGER) AS h, list_has_any({_WORDS}, ['red', 'blue']) AS i,
         array_to_string(flatten([{_WORDS}, ['q']]), ',') AS j, {_WORDS}[1] AS k, array_to_string(list_filter({_WORDS}, lambda w: w = 'red' OR w = 'ring'), ',') AS l FROM part""",
)
def arrays(read):
    w = _words()

    def text(c):
        return F.array_join(c, ",")

    some = F.array(F.lit("red"), F.lit("ring"))
    cells = {
        "a": text(F.array_append(w, "x")),
        "b": text(F.array_prepend(w, "x")),
        "c": text(F.concat(w, F.array(F.lit("y"), F.lit("z")))),
        "d": text(F.sort_array(F.array_distinct(F.concat(w, w)))),
        "e": text(F.array_remove(w, "red")),
        "f": F.array_contains(w, "red"),
        "g": F.array_position(w, "red"),
        "h": F.size(w),
        "i": F.arrays_overlap(w, F.array(F.lit("red"), F.lit("blue"))),
        "j": text(F.flatten(F.array(w, F.array(F.lit("q"))))),
        "k": F.get(w, F.lit(0)),
        "l": text(F.array_compact(F.transform(w, lambda x: F.when(F.array_contains(some, x), x)))),
    }
    return read("part").select("p_partkey", *[c.alias(n) for n, c in cells.items()])


@query(
    "F48_array_sets",
    f"""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter({_WORDS}, lambda w: w NOT IN ('red', 'small')))), ',') AS a,
         array_to_string(list_sort(list_distinct(list_filter({_WORDS}, lambda w: w IN ('red', 'small')))), ',') AS b FROM part""",
)
def array_sets(read):
    other = F.array(F.lit("red"), F.lit("small"))
    return read("part").select(
        "p_partkey",
        F.array_join(F.sort_array(F.array_except(_words(), other)), ",").alias("a"),
        F.array_join(F.sort_array(F.array_intersect(_words(), other)), ",").alias("b"),
    )


@query("F49_array_contains", f"SELECT p_partkey, list_contains({_WORDS}, p_type) AS a, list_contains({_WORDS}, 'ring') AS b FROM part")
def array_contains(read):
    return read("part").select(
        "p_partkey", C.array_contains(F.col("p_type"), _words()).alias("a"), C.array_contains("ring", _words()).alias("b")
    )


@query(
    "F50_array_construct_compact",
    f"""SELECT p_partkey, array_to_string(list_filter([{_N}, {_N}, p_size, NULL], lambda x: x IS NOT NULL), ',') AS a FROM part""",
)
def array_construct_compact(read):
    return read("part").select(
        "p_partkey", F.array_join(C.array_construct_compact(_n(), _n(), F.col("p_size"), F.lit(None)), ",").alias("a")
    )


@query("F51_array_slice", "SELECT vec_id, CAST(len(embedding[3:6]) AS INTEGER) AS n, embedding[3] AS first, embedding[6] AS last, embedding[1] AS head FROM embeddings")
def array_slice(read):
    part = C.array_slice(F.col("embedding"), 2, 6)
    return read("embeddings").select(
        "vec_id",
        F.size(part).alias("n"),
        F.get(part, F.lit(0)).alias("first"),
        F.element_at(part, -1).alias("last"),
        F.get(C.array_slice(F.col("embedding"), 0, 1), F.lit(0)).alias("head"),
    )


@query(
    "F52_flatten",
    """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, UNNEST(embedding) AS value FROM embeddings""",
)
def flatten(read):
    return read("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@query(
    "F52_flatten_outer",
    """SELECT event_id, json_extract_string(props, '$.k') AS value FROM events""",
)
def flatten_outer(read):
    """A path into semi-structured text, exploded; a row without elements stays."""
    props = F.from_json("props", "map<string,string>")
    e = read("events").select("event_id", F.explode_outer(F.map_values(props)).alias("value"))
    return e


@query(
    "F53_unnest",
    """SELECT p_partkey, 'name' AS key, p_name AS value FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part UNION ALL
       SELECT p_partkey, 'word', UNNEST(string_split(p_name, ' ')) FROM part""",
)
def unnest(read):
    m = F.create_map(F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type"))
    pairs = read("part").select("p_partkey", F.explode(m).alias("key", "value"))
    words = read("part").select("p_partkey", F.lit("word").alias("key"), F.explode(F.split("p_name", " ")).alias("value"))
    return pairs.unionByName(words)


@query("F54_any_keys_match", "SELECT p_partkey, starts_with(p_name, 's') OR starts_with(p_type, 's') AS a FROM part")
def any_keys_match(read):
    keys = F.array_distinct(F.array("p_name", "p_type"))
    m = F.map_from_arrays(keys, F.transform(keys, F.length))
    return read("part").select("p_partkey", C.any_keys_match(m, lambda k: k.startswith("s")).alias("a"))


@query("F55_object_construct", """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS o, n_name AS name FROM nation""")
def object_construct(read):
    o = F.named_struct(F.lit("name"), F.col("n_name"), F.lit("region"), F.col("n_regionkey"))
    return read("nation").select("n_nationkey", F.to_json(o).alias("o"), o.getField("name").alias("name"))


@query("F56_object_keys", "SELECT event_id, array_to_string(json_keys(props), ',') AS keys FROM events")
def object_keys(read):
    return read("events").select("event_id", F.array_join(F.json_object_keys("props"), ",").alias("keys"))


@query(
    "F57_parse_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS deep, true AS bad FROM events""",
)
def parse_json(read):
    nested = F.concat(F.lit('{"a": {"b": ['), F.get_json_object("props", "$.k"), F.lit("]}}"))
    return read("events").select(
        "event_id",
        F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"),
        (F.variant_get(F.try_parse_json(nested), "$.a.b[0]", "long") + 1).alias("deep"),
        F.try_parse_json(F.concat(F.lit("{"), "props")).isNull().alias("bad"),
    )


@query(
    "F58_json_path_text",
    """SELECT event_id, json_extract_string(props, '$.k') AS a, json_extract_string(props, '$.k') AS b, event_type AS c FROM events""",
)
def json_path_text(read):
    packed = F.to_json(F.struct(F.array("event_type", F.lit("z")).alias("list")))
    return read("events").select(
        "event_id",
        C.json_extract_path_text(F.col("props"), "k").alias("a"),
        C.json_extract_path_text(F.col("props"), F.substring(F.lit("ak"), 2, 1)).alias("b"),
        C.json_extract_path_text(packed, "list", 0).alias("c"),
    )


@query(
    "F59_json_size",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE 0 END END AS n FROM part""",
)
def json_size(read):
    texts = ['{"x": {"a": 1, "b": 2}}', '{"x": [1, 2, 3]}', '{"x": 42}', '{"x": "text"}', "no json"]
    doc = F.get(F.array(*[F.lit(t) for t in texts]), (F.col("p_partkey") % 5).cast("int"))
    return read("part").select("p_partkey", C.json_size(doc, "$.x").alias("n"))


@query("F60_valid_json", "SELECT event_id, json_valid(CASE WHEN event_id % 3 = 0 THEN props || '}' ELSE props END) AS ok, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def valid_json(read):
    doc = F.when(F.col("event_id") % 3 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return read("events").select(
        "event_id", C.is_valid_json(doc).alias("ok"), F.from_json("props", "k int").getField("k").alias("k")
    )


@query(
    "F61_series",
    """SELECT p_partkey, UNNEST(generate_series(1, p_size, 7)) AS n, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words FROM part""",
)
def series(read):
    return read("part").select(
        "p_partkey",
        F.size(F.split("p_name", " ")).alias("words"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("p_size").cast("long"), F.lit(7).cast("long"))).alias("n"),
    )
