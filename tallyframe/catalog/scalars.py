"""Arithmetic, text and date expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.registry import SHIP, query, rnd, ship
from tallyframe.functions import scalars as S
from tallyframe.sources.tables import literal_frame


@query("math_arith", """SELECT o_orderkey, o_totalprice + o_custkey AS a, o_totalprice - o_custkey AS s, o_totalprice * 3 AS m,
 CASE WHEN o_custkey <> 0 THEN o_totalprice / o_custkey END AS d, round(pow(o_totalprice, 2), 2) AS p FROM orders""")
def _(t):
    x, k = F.col("o_totalprice"), F.col("o_custkey")
    return t.orders.select("o_orderkey", (x + k).alias("a"), (x - k).alias("s"), (x * 3).alias("m"),
                           F.try_divide(x, k).alias("d"), F.round(F.pow(x, F.lit(2)), 2).alias("p"))


@query("math_funcs", """SELECT c_custkey, round(sqrt(abs(c_acctbal)), 8) AS root, abs(c_acctbal) AS magnitude,
 round(ln(nullif(abs(c_acctbal), 0)), 8) AS ln, round(log10(nullif(abs(c_acctbal), 0)), 8) AS log10,
 round(exp(c_acctbal / 1000), 6) AS ex FROM customer""")
def _(t):
    x = F.abs("c_acctbal")
    return rnd(t.customer.select("c_custkey", F.sqrt(x).alias("root"), x.alias("magnitude"), F.ln(x).alias("ln"),
                                 F.log10(x).alias("log10"), F.exp(F.col("c_acctbal") / 1000).alias("ex")), 8, ex=6)


@query("math_log1p", "SELECT event_id, round(ln(1 + value), 8) AS log1p_value FROM events")
def _(t):
    return rnd(t.events.select("event_id", F.log1p("value").alias("log1p_value")), 8)


@query("math_trig", """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 8) + 0.0 AS s, round(cos(2 * pi() * hour(ts) / 24), 8) + 0.0 AS c,
 round(pi() * value, 6) AS turn FROM events""")
def _(t):
    angle = 2 * F.pi() * F.hour("ts") / 24
    df = t.events.select("event_id", F.sin(angle).alias("s"), F.cos(angle).alias("c"), (F.pi() * F.col("value")).alias("turn"))
    return rnd(df, 8, turn=6).withColumns({k: F.col(k) + 0.0 for k in ("s", "c")})


@query("math_round_ceil", """SELECT event_id, round(value, 1) AS r, ceil(value)::BIGINT AS c, floor(value)::BIGINT AS f,
 round(value * 10) / 10 AS tenth FROM events""")
def _(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(v, 1).alias("r"), F.ceil(v).alias("c"), F.floor(v).alias("f"),
                           (F.round(v * 10) / 10).alias("tenth"))


@query("math_minmax_pair", "SELECT event_id, greatest(10, value) AS at_least, least(100, value) AS at_most FROM events")
def _(t):
    return t.events.select("event_id", F.greatest(F.lit(10.0), "value").alias("at_least"),
                           F.least(F.lit(100.0), "value").alias("at_most"))


@query("pipe_chain", "SELECT c_mktsegment, round(sqrt(abs(avg(-c_acctbal))), 6) AS r FROM customer GROUP BY 1")
def _(t):
    return rnd(t.customer.groupBy("c_mktsegment").agg(F.sqrt(F.abs(F.avg(-F.col("c_acctbal")))).alias("r")))


@query("str_length", "SELECT doc_id, length(text) AS n FROM documents")
def _(t):
    return t.documents.select("doc_id", F.char_length("text").cast("long").alias("n"))


@query("str_case", "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, upper(p_name[1]) || p_name[2:] AS first FROM part")
def _(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
                         F.concat(F.upper(F.substring("p_name", 1, 1)), F.substr("p_name", F.lit(2))).alias("first"))


@query("str_title", """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
 lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part""")
def _(t):
    return t.part.select("p_partkey", S.str_title(F.col("p_name")).alias("title"))


@query("str_detect", "SELECT doc_id, regexp_matches(text, '[0-9]{3,}') AS has_number FROM documents")
def _(t):
    return t.documents.select("doc_id", F.col("text").rlike("[0-9]{3,}").alias("has_number"))


@query("str_replace", "SELECT page_id, regexp_replace(url, '[a-z]+', 'X') AS url FROM pages")
def _(t):
    return t.pages.select("page_id", S.str_replace_first(F.col("url"), "[a-z]+", "X").alias("url"))


@query("str_replace_all", "SELECT p_partkey, regexp_replace(p_name, ' ', '_', 'g') AS name FROM part")
def _(t):
    return t.part.select("p_partkey", F.regexp_replace("p_name", " ", "_").alias("name"))


@query("str_starts_ends", """SELECT p_partkey, regexp_matches(p_name, '^(?:red|big)') AS starts,
 regexp_matches(p_name, '(?:g.ar)$') AS ends FROM part""")
def _(t):
    return t.part.select("p_partkey", S.str_starts(F.col("p_name"), "red|big").alias("starts"),
                         S.str_ends(F.col("p_name"), "g.ar").alias("ends"))


@query("str_sub", "SELECT p_partkey, substring(p_name, 1, 6) AS head FROM part")
def _(t):
    return t.part.select("p_partkey", F.substring("p_name", 1, 6).alias("head"))


@query("str_trim_squish", r"""SELECT p_partkey, trim(s, ' ') AS trimmed, trim(regexp_replace(s, '\s+', ' ', 'g'), ' ') AS squished
FROM (SELECT p_partkey, '  ' || p_name || '   ' || p_brand || ' ' AS s FROM part)""")
def _(t):
    s = F.concat(F.lit("  "), "p_name", F.lit("   "), "p_brand", F.lit(" "))
    return t.part.select("p_partkey", F.trim(s).alias("trimmed"), S.str_squish(s).alias("squished"))


@query("str_count", "SELECT doc_id, length(regexp_extract_all(text, 'a'))::INT AS n FROM documents")
def _(t):
    return t.documents.select("doc_id", F.regexp_count("text", F.lit("a")).alias("n"))


@query("str_pad", "SELECT o_orderkey, CASE WHEN length(s) >= 4 THEN s ELSE lpad(s, 4, '0') END AS padded FROM (SELECT o_orderkey, o_orderkey::VARCHAR AS s FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", S.str_pad(F.col("o_orderkey").cast("string"), 4, "0").alias("padded"))


@query("str_clean_chain", """SELECT p_partkey, array_to_string(list_transform(string_split(lower(trim(s, ' ')), ' '),
 lambda w: upper(w[1]) || w[2:]), ' ') AS clean FROM (SELECT p_partkey, '  ' || upper(p_name) || ' ' AS s FROM part)""")
def _(t):
    messy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return t.part.select("p_partkey", S.str_title(F.trim(messy)).alias("clean"))


@query("str_paste", """SELECT p_partkey, p_brand || p_size AS tight, concat_ws(' ', p_type, p_name) AS spaced FROM part""")
def _(t):
    return t.part.select("p_partkey", F.concat("p_brand", F.col("p_size").cast("string")).alias("tight"),
                         F.concat_ws(" ", "p_type", "p_name").alias("spaced"))


@query("str_format", """SELECT p_partkey, format('{:.1f}%', p_size * 1.0) AS pct, '$' || format('{:,}', round(p_retailprice * 100)::BIGINT) AS money FROM part""")
def _(t):
    return t.part.select("p_partkey", S.percent_label(F.col("p_size") * F.lit(1.0)).alias("pct"),
                         S.dollar_label(F.round(F.col("p_retailprice") * 100)).alias("money"))


_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_DAYS = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun']"


@query("date_parts", """SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day_of_month,
 ((dayofyear(ts) - 1) // 7 + 1)::INT AS week_of_year, quarter(ts)::INT AS quarter, hour(ts)::INT AS hour_of_day FROM events""")
def _(t):
    f = S.date_features(F.col("ts"))
    return t.events.select("event_id", *[f[k].alias(k) for k in (
        "year", "month", "day_of_month", "week_of_year", "quarter", "hour_of_day")])


@query("date_labels", f"SELECT o_orderkey, {_MONTHS}[month(o_orderdate)] AS month_name, {_DAYS}[isodow(o_orderdate)] AS day_of_week FROM orders")
def _(t):
    f = S.date_features(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", f["month_name"].alias("month_name"), f["day_of_week"].alias("day_of_week"))


@query("date_flags", """SELECT event_id, isodow(ts) IN (6, 7) AS is_weekend, hour(ts) BETWEEN 9 AND 16 AS is_peak_hour,
 month(ts) IN (1, 5, 12) AS is_holiday_month FROM events""")
def _(t):
    f = S.date_features(F.col("ts"), peak_hours=list(range(9, 17)), holiday_months=[1, 5, 12])
    return t.events.select("event_id", *[f[k].alias(k) for k in ("is_weekend", "is_peak_hour", "is_holiday_month")])


@query("cyclical_encoding", """SELECT event_id, round(sin(hour(ts) * (2 * pi() / 24)), 8) + 0.0 AS hour_sin, round(cos(hour(ts) * (2 * pi() / 24)), 8) + 0.0 AS hour_cos,
 round(sin(month(ts) * (2 * pi() / 12)), 8) + 0.0 AS month_sin, round(cos(month(ts) * (2 * pi() / 12)), 8) + 0.0 AS month_cos FROM events""")
def _(t):
    f = S.date_features(F.col("ts"))
    names = ["hour_sin", "hour_cos", "month_sin", "month_cos"]
    df = rnd(t.events.select("event_id", *[f[k].alias(k) for k in names]), 8)
    return df.withColumns({k: F.col(k) + 0.0 for k in names})


@query("quarter_label", f"WITH {SHIP} SELECT 'Q' || ceil(month / 3.0)::INT AS quarter, count(*) AS n FROM ship GROUP BY 1")
def _(t):
    return ship(t).groupBy(S.quarter_label(F.col("month")).alias("quarter")).agg(F.count("*").alias("n"))


@query("array_ops", """SELECT vec_id, embedding[1] AS first, embedding[1] + embedding[3] AS first_and_third,
 round(list_sum(list_transform(embedding[2:5], lambda x: x::DOUBLE * 10)), 4) AS middle, len(embedding)::INT AS size FROM embeddings""")
def _(t):
    e = F.col("embedding")
    middle = F.aggregate(F.transform(F.slice(e, 2, 4), lambda x: x.cast("double") * 10), F.lit(0.0), lambda a, x: a + x)
    df = t.embeddings.select("vec_id", F.element_at(e, 1).alias("first"), (e[0] + e[2]).alias("first_and_third"),
                             middle.alias("middle"), F.size(e).alias("size"))
    return df.withColumn("middle", F.round("middle", 4))


@query("udf_celsius", "SELECT event_id, value * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE AS fahrenheit FROM events")
def _(t):
    return t.events.select("event_id", S.celsius_to_fahrenheit(F.col("value")).alias("fahrenheit"))


# Grade thresholds, highest first.
GRADES = [(90, "A"), (80, "B"), (0, "C")]


@query("grade_letters", """SELECT letter, count(*) AS n, sum(passed::INT)::BIGINT AS passed FROM (SELECT
 CASE WHEN p_size * 2 >= 90 THEN 'A' WHEN p_size * 2 >= 80 THEN 'B' WHEN p_size * 2 >= 0 THEN 'C' END AS letter,
 p_size * 2 >= 80 AS passed FROM part) GROUP BY 1""")
def _(t):
    grade = F.col("p_size") * 2
    letter = S.case_when(*[(grade >= cut, F.lit(mark)) for cut, mark in GRADES])
    return t.part.groupBy(letter.alias("letter")).agg(
        F.count("*").alias("n"), F.count_if(grade >= 80).alias("passed"))
