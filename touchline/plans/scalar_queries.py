"""Registered queries: text categories, cleaning and price scalars, batch tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import clean, odds as O, text
from touchline.operators import features
from touchline.operators import profile as P
from touchline.operators import scoring as SC
from touchline.plans import bindings
from touchline.plans.eval_queries import _ALL, _holdout_vote, _split_fixtures
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, with_ctes
from touchline.plans.registry import normalise, query
from touchline.session import spread
from touchline.sources.tables import table


def _flags_sql(column: str, patterns) -> str:
    return " || ".join(f"CASE WHEN regexp_matches({column}, '{p}') THEN '1' ELSE '0' END" for p in patterns)


@query("shot_text_categories", with_ctes(FIXTURES_CTE, EVENTS_CTE) + f"""
, t AS (SELECT id, qualifier_text AS t, regexp_replace(lower(qualifier_text), '[^a-z0-9]+', '', 'g') AS c FROM qual)
SELECT id, {_flags_sql("t", [lit for _, lit in text.SHOT_KEYWORD_FLAGS])} AS keyword_flags, {_flags_sql("c", text.SHOT_REGEX_FLAGS.values())} AS regex_flags,
       CASE WHEN c LIKE '%head%' THEN 'Head' WHEN c LIKE '%rightfoot%' THEN 'Right foot' WHEN c LIKE '%leftfoot%' THEN 'Left foot' ELSE 'Other' END AS body_part,
       CASE WHEN c LIKE '%smallbox%' THEN 'SmallBox' WHEN regexp_matches(c, 'boxcentre|boxcenter|boxleft|boxright') THEN 'Box'
            WHEN c LIKE '%outofbox%' THEN 'OutOfBox' ELSE 'Unknown' END AS text_zone
FROM t
""")
def shot_text_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F4 + F5 (all 19 flags) + F6 (nine flags) + F7 (body part, zone) of every shot's qualifier text."""
    q = bindings.shot_qualifiers(spark, sf_dir).select("id", text.qualifiers_to_text("qualifiers").alias("t"))
    q = q.withColumn("c", text.compact_text("t"))
    by_regex = text.regex_flags("c", text.SHOT_REGEX_FLAGS)
    digits = lambda flags: F.concat(*[f.cast("string") for f in flags.values()])
    return normalise(q.select("id", digits(text.keyword_flags("t")).alias("keyword_flags"), digits(by_regex).alias("regex_flags"),
                              text.body_part(by_regex).alias("body_part"), text.text_zone("c").alias("text_zone")))


@query("cleaning_scalars", """
WITH s AS (
  SELECT c_custkey AS k, c_acctbal AS b, CASE c_custkey % 5 WHEN 0 THEN ' Man Utd. ' WHEN 1 THEN 'Spurs' WHEN 2 THEN 'Wolves' WHEN 3 THEN NULL ELSE 'Arsenal FC' END AS name,
         CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END AS given,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 3 END AS x, c_custkey % 2 AS y FROM customer)
SELECT k, CASE trim(coalesce(name, '')) WHEN 'Man Utd.' THEN 'Man United' WHEN 'Spurs' THEN 'Tottenham' WHEN 'Arsenal FC' THEN 'Arsenal' ELSE trim(coalesce(name, '')) END AS canonical,
       round(coalesce(TRY_CAST(given AS DOUBLE), b), 6) AS coalesced, CAST(x IS NOT NULL AND NOT (x = 0 AND y = 0) AS BIGINT) AS located,
       round(round_even(k * 0.125, 2), 6) AS rounded, round(CASE WHEN k % 7 = 0 THEN 0.0 ELSE b END, 6) AS finite,
       CAST(x IS NOT NULL AND name IS NOT NULL AS BIGINT) AS ready, coalesce(nullif(name, ''), 'Jugador no identificado') AS player FROM s
""")
def cleaning_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 (alias hits) + P7 + P9 + P11 + P16 + P17 + P18 on customer rows."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, " Man Utd. ").when(k % 5 == 1, "Spurs").when(k % 5 == 2, "Wolves").when(k % 5 == 4, "Arsenal FC")
    s = table(spark, sf_dir, "customer").select(
        k.alias("k"), F.col("c_acctbal").cast("double").alias("b"), name.alias("name"), F.when(k % 3 == 0, "n/a").otherwise(k.cast("string")).alias("given"),
        F.when(k % 4 != 0, k % 3).alias("x"), (k % 2).alias("y"), (k * F.lit(0.125)).alias("eighths"),
        F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal").cast("double")).alias("odd"))
    ready = clean.ready_rows(s, ["x", "name"]).select(F.col("k").alias("rk"))
    out = s.join(ready, F.col("k") == F.col("rk"), "left")
    return normalise(out.select(
        "k", clean.canonical_name("name").alias("canonical"), clean.coalesce_numeric("given", F.col("b")).alias("coalesced"),
        clean.valid_location("x", "y").alias("located"), clean.round_half_even("eighths", 2).alias("rounded"),
        clean.finite_or("odd", 0.0).alias("finite"), F.col("rk").isNotNull().alias("ready"), clean.default_name("name").alias("player")))


@query("normalised_price_probabilities", with_ctes(FIXTURES_CTE) + """
, r AS (SELECT id, CASE WHEN id % 9 = 0 THEN NULL ELSE 1 / b365h END AS h, 1 / b365d AS d, 1 / b365a AS a, hs, hst FROM fixtures)
SELECT id, round(h / (coalesce(h, 0) + d + a), 6) AS b365_home_prob_norm, round(d / (coalesce(h, 0) + d + a), 6) AS b365_draw_prob_norm,
       round(a / (coalesce(h, 0) + d + a), 6) AS b365_away_prob_norm, round(1 / (1 + exp(-(-1.5 + -0.08 * hs + 0.04 * hst))), 6) AS simple_xg FROM r
""")
def normalised_price_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10 (a missing price is left out of the sum) + X17."""
    fx = bindings.fixtures(spark, sf_dir).withColumn("b365h", F.when(F.pmod("id", F.lit(9)) != 0, F.col("b365h")))
    out = features.normalised_market_probs(fx).withColumn("simple_xg", O.simple_xg(F.col("hs").cast("double"), F.col("hst").cast("double")))
    return normalise(out.select("id", "b365_home_prob_norm", "b365_draw_prob_norm", "b365_away_prob_norm", "simple_xg"))


@query("goals_median_by_result", with_ctes(FIXTURES_CTE) + """
, o AS (SELECT ftr, total_goals, row_number() OVER (PARTITION BY ftr ORDER BY total_goals) - 1 AS i, count(*) OVER (PARTITION BY ftr) AS n FROM fixtures)
SELECT ftr, round(avg(total_goals), 6) AS mean, round(quantile_cont(total_goals, 0.5), 6) AS median,
       round(max(CASE WHEN i = n // 2 THEN total_goals END), 6) AS upper_median, CAST(count(*) AS BIGINT) AS n FROM o GROUP BY ftr
""")
def goals_median_by_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, interpolated and upper median per class by distributed rank."""
    return normalise(P.mean_median(bindings.fixtures(spark, sf_dir), "total_goals", "ftr"))


_TASKS_SQL = _ALL + """
, req AS (SELECT f.id AS row_id, f.home_team, f.away_team, f.b365h, f.b365d, f.b365a, f.total_goals FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
lg0 AS (SELECT avg(CASE WHEN ftr = 'H' THEN 1.0 ELSE 0.0 END) AS h, avg(CASE WHEN ftr = 'D' THEN 1.0 ELSE 0.0 END) AS d,
               avg(CASE WHEN ftr = 'A' THEN 1.0 ELSE 0.0 END) AS a FROM fixtures f JOIN split2 s ON s.id = f.id WHERE s.is_train),
st0 AS (SELECT f.home_team, f.away_team, 20.0 + f.id % 50 AS ph, 30.0 AS pd, 50.0 - f.id % 50 AS pa, CASE WHEN f.id % 4 = 0 THEN NULL ELSE f.total_goals END AS g,
               row_number() OVER (PARTITION BY f.home_team, f.away_team ORDER BY f.id DESC) AS rn FROM fixtures f JOIN split2 s ON s.id = f.id WHERE s.is_train OR f.id % 2 = 0),
cl AS (SELECT home_team, away_team, greatest(0.001, least(0.999, ph / 100)) AS h, greatest(0.001, least(0.999, pd / 100)) AS d, greatest(0.001, least(0.999, pa / 100)) AS a,
              greatest(coalesce(g, 2.7), 0.0) AS g FROM st0 WHERE rn = 1),
j AS (SELECT r.row_id, CASE WHEN r.row_id % 3 = 0 AND e.row_id IS NOT NULL THEN 'ensemble' WHEN cl.h IS NOT NULL THEN 'stored' WHEN r.row_id % 5 <> 0 THEN 'market' ELSE 'league_average_fallback' END AS source,
             e.p_home, e.p_draw, e.p_away, e.predicted_total_goals AS eg, cl.h, cl.d, cl.a, cl.g, r.b365h, r.b365d, r.b365a, r.total_goals, lg0.h AS lh, lg0.d AS ld, lg0.a AS la
      FROM req r LEFT JOIN ens e ON e.row_id = r.row_id LEFT JOIN cl ON cl.home_team = r.home_team AND cl.away_team = r.away_team CROSS JOIN lg0),
p AS (SELECT row_id, source, CASE source WHEN 'ensemble' THEN p_home WHEN 'stored' THEN h WHEN 'market' THEN (1 / b365h) / (1 / b365h + 1 / b365d + 1 / b365a) ELSE lh END AS ph,
             CASE source WHEN 'ensemble' THEN p_draw WHEN 'stored' THEN d WHEN 'market' THEN (1 / b365d) / (1 / b365h + 1 / b365d + 1 / b365a) ELSE ld END AS pd,
             CASE source WHEN 'ensemble' THEN p_away WHEN 'stored' THEN a WHEN 'market' THEN (1 / b365a) / (1 / b365h + 1 / b365d + 1 / b365a) ELSE la END AS pa,
             greatest(CASE source WHEN 'ensemble' THEN coalesce(eg, 2.7) WHEN 'stored' THEN g WHEN 'market' THEN total_goals ELSE 2.7 END, 0.0) AS eg FROM j),
c AS (SELECT row_id, source, eg, greatest(least(ph, 0.999), 0.001) AS ch, greatest(least(pd, 0.999), 0.001) AS cd, greatest(least(pa, 0.999), 0.001) AS ca FROM p),
q2 AS (SELECT row_id, source, eg, ch / (ch + cd + ca) AS h, cd / (ch + cd + ca) AS d, ca / (ch + cd + ca) AS a,
             CASE WHEN ch >= cd AND ch >= ca THEN 'H' WHEN cd >= ca THEN 'D' ELSE 'A' END AS pick, CASE WHEN source = 'ensemble' THEN 'ensemble' ELSE 'fallback' END AS mode FROM c)"""


def _batch_sources(spark: SparkSession, sf_dir: str):
    fxs = _split_fixtures(spark, sf_dir)
    held = fxs.filter(~F.col("is_train")).withColumnRenamed("id", "row_id")
    batch = held.select("row_id", "home_team", "away_team")
    k = F.col("id")
    stored = fxs.filter(F.col("is_train") | (F.pmod("id", F.lit(2)) == 0)).select(
        F.col("home_team").alias("home"), F.col("away_team").alias("away"), (20.0 + F.pmod("id", F.lit(50))).alias("prob_home"),
        F.lit(30.0).alias("prob_draw"), (50.0 - F.pmod("id", F.lit(50))).alias("prob_away"),
        F.when(F.pmod("id", F.lit(4)) != 0, F.col("total_goals")).alias("est_goals"), k.alias("position"))
    vote = _holdout_vote(spark, sf_dir, keep=()).filter(F.pmod("row_id", F.lit(3)) == 0)
    market = SC.market_probabilities(held.filter(F.pmod("row_id", F.lit(5)) != 0).select("row_id", "b365h", "b365d", "b365a", "total_goals"))
    names = ("p_home", "p_draw", "p_away", "goals")
    sources = {"ensemble": vote.select("row_id", *names[:3], F.col("predicted_total_goals").alias("goals")),
               "stored": SC.stored_predictions(batch, stored),
               "market": market.select("row_id", *[F.col(f"mk_{c.split('_')[-1]}").alias(c) for c in names])}
    return batch, sources, SC.league_average(fxs.filter("is_train"))


@query("match_full_batch", _TASKS_SQL + """
SELECT row_id, source, mode, round(h, 6) AS home_win_probability, round(d, 6) AS draw_probability, round(a, 6) AS away_win_probability, pick AS predicted_result,
       round(eg, 6) AS expected_goals FROM q2
""")
def match_full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E22 + E23 + E25 + E27 + E31 + J11: the full match task through ensemble, stored (by team pair, last
    duplicate wins), market (own goals) and league average."""
    batch, sources, league = _batch_sources(spark, sf_dir)
    scored = SC.score_match_batch(batch, "match", sources, league)
    return normalise(scored.select("row_id", "source", "mode", "home_win_probability", "draw_probability", "away_win_probability",
                                   "predicted_result", "expected_goals"))


@query("match_batch_summaries", _TASKS_SQL + """
, o AS (SELECT CASE max(CASE mode WHEN 'ensemble' THEN 2 ELSE 0 END) WHEN 2 THEN 'ensemble' ELSE 'fallback' END AS mode FROM q2)
SELECT 'match_result' AS task, (SELECT mode FROM o) AS mode, CAST(count(*) AS BIGINT) AS rows, CAST(sum(CASE WHEN pick = 'H' THEN 1 ELSE 0 END) AS BIGINT) AS predicted_h,
       CAST(sum(CASE WHEN pick = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS predicted_d, CAST(sum(CASE WHEN pick = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS predicted_a,
       CAST(NULL AS DOUBLE) AS mean_expected_goals FROM q2
UNION ALL SELECT 'match_goals', (SELECT mode FROM o), CAST(count(*) AS BIGINT), NULL, NULL, NULL, round(avg(eg), 6) FROM q2
UNION ALL SELECT 'match_full', (SELECT mode FROM o), CAST(count(*) AS BIGINT), CAST(sum(CASE WHEN pick = 'H' THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN pick = 'D' THEN 1 ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN pick = 'A' THEN 1 ELSE 0 END) AS BIGINT), round(avg(eg), 6) FROM q2
""")
def match_batch_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E27 + E28 + A33: every match task over the same batch: its output columns, summary and overall mode."""
    batch, sources, league = _batch_sources(spark, sf_dir)
    out = None
    for task in ("match_result", "match_goals", "match_full"):
        scored = SC.score_match_batch(batch, task, sources, league).checkpoint(eager=True)
        one = SC.batch_summary_match(scored).crossJoin(SC.overall_mode(scored))
        wanted = {"predicted_h": "predicted_H", "predicted_d": "predicted_D", "predicted_a": "predicted_A", "mean_expected_goals": "mean_expected_goals"}
        one = one.select(F.lit(task).alias("task"), "mode", "rows", *[
            (F.col(c) if c in one.columns else F.lit(None)).cast("double" if c.startswith("mean") else "long").alias(n) for n, c in wanted.items()])
        out = one if out is None else out.unionByName(one)
    return normalise(out)


@query("literal_names", """
WITH c AS (SELECT c_custkey AS k, c_name AS n, c_custkey % 9 AS kind FROM customer)
SELECT k, CASE kind WHEN 0 THEN n || '|' || 'O''Neil' WHEN 1 THEN n || '|' || 'O''Neil' WHEN 2 THEN n WHEN 3 THEN n || '|plain|True' WHEN 4 THEN 'say "' || n || '", None'
                    WHEN 5 THEN '[' || n || ' ''broken' WHEN 6 THEN '' WHEN 7 THEN n ELSE 'A' || n END AS names,
       lower(CASE kind WHEN 0 THEN n || ' 5 O''Neil' WHEN 1 THEN n || ' 5 O''Neil' WHEN 2 THEN n || ' True' WHEN 3 THEN n || ' plain True' WHEN 4 THEN 'say "' || n || '", None'
                    WHEN 5 THEN '[' || n || ' ''broken' WHEN 6 THEN '' WHEN 7 THEN n || ' [1]' ELSE 'A' || n END) AS tokens FROM c
""")
def literal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + F3: names and token text of literals made from customer names: JSON, Python literals with both quotes, nesting,
    escapes, None and True, broken and blank text."""
    n = F.col("c_name")
    made = [F.concat(F.lit('[{"type": {"displayName": "'), n, F.lit('"}, "value": "5"}, {"type": {"displayName": "O\'Neil"}, "value": null}]')),
            F.concat(F.lit("[{'type': {'displayName': '"), n, F.lit("'}, 'value': 5}, {'type': {'displayName': \"O'Neil\"}, 'value': None, 'more': [{'a': (1, 2)}, '}']}]")),
            F.concat(F.lit(" {'type': {'displayName': '"), n, F.lit("', 'value': 31}, 'value': 'True'} ")),
            F.concat(F.lit("['"), n, F.lit("', \"plain\", '', 0, None, False, True]")),
            F.concat(F.lit("['say \""), n, F.lit("\", None']")), F.concat(F.lit("["), n, F.lit(" 'broken")), F.lit("  "),
            F.concat(F.lit('{"type": {"displayName": "'), n, F.lit('"}, "value": "[1]"}')), F.concat(F.lit("['\\x41"), n, F.lit("',]"))]
    literal = F.element_at(F.array(*made), (F.col("c_custkey") % 9 + 1).cast("int"))
    return normalise(spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name")).select(
        F.col("c_custkey").alias("k"), F.array_join(text.qualifier_names_lenient(literal), "|").alias("names"), text.qualifiers_text_lenient(literal).alias("tokens")))
