"""Identity queries.

Bindings: ``customer`` rows with a non-negative balance are the known users
(``c_custkey -> c_name``); orders with status O / F / P give followings, followers and
two-party DM conversation ids ``custkey-orderkey``; ``events`` give the user harvest
(the event's user with a handle from the event type, then the user named in ``props.k``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII, UNKNOWN_HANDLE, USER_URL_PREFIX
from threadsmith.operators import identity
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.registry import register, table

CFG = ASCII


def users(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return c.select(F.col("c_custkey").cast("string").alias("user_id"), F.col("c_name").alias("handle"))


def id_sets(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    following = identity.ids(o.filter(F.col("o_orderstatus") == "O"), "o_custkey")
    followers = identity.ids(o.filter(F.col("o_orderstatus") == "F"), "o_custkey")
    convs = o.filter(F.col("o_orderstatus") == "P").select(
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("conversation_id"))
    dms = identity.dm_ids(convs)
    return following, followers, dms


def members(spark, sf) -> DataFrame:
    """The membership table from one ``orders`` scan (each order tags its ids with their
    source) plus the known users."""
    o = table(spark, sf, "orders")
    st, ck = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    conv = F.concat_ws("-", ck, F.col("o_orderkey").cast("string"))
    tags = (F.when(st == "O", F.array(F.struct(ck.alias("user_id"), F.lit("following").alias("source"))))
            .when(st == "F", F.array(F.struct(ck.alias("user_id"), F.lit("followers").alias("source"))))
            .when(st == "P", F.transform(F.split(conv, "-"),
                                         lambda x: F.struct(x.alias("user_id"), F.lit("dm").alias("source")))))
    tagged = o.select(F.inline(tags)).filter(F.col("user_id").isNotNull())
    known = users(spark, sf).select("user_id", F.lit("known").alias("source"))
    return identity.membership_of(tagged.unionByName(known))


SETS_SQL = """fo AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id FROM orders WHERE o_orderstatus = 'O'),
fr AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id FROM orders WHERE o_orderstatus = 'F'),
dm AS (SELECT DISTINCT unnest(string_split(CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR), '-'))
         AS user_id FROM orders WHERE o_orderstatus = 'P'),
wo AS (SELECT user_id FROM fo UNION SELECT user_id FROM dm),
oo AS (SELECT user_id FROM fr EXCEPT SELECT user_id FROM wo),
al AS (SELECT user_id FROM wo UNION SELECT user_id FROM oo),
us AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS handle FROM customer WHERE c_acctbal >= 0),
unk AS (SELECT user_id FROM al EXCEPT SELECT user_id FROM us),
unkf AS (SELECT user_id FROM unk INTERSECT SELECT user_id FROM oo)"""


@register("id_universe", oracle=f"""WITH {SETS_SQL}
SELECT user_id, user_id IN (SELECT user_id FROM oo) AS only_follower FROM al""")
def id_universe(spark: SparkSession, sf: str) -> DataFrame:
    return members(spark, sf).filter("in_all").select("user_id", "only_follower")


@register("followers_only", oracle=f"WITH {SETS_SQL} SELECT user_id FROM oo")
def followers_only(spark: SparkSession, sf: str) -> DataFrame:
    return members(spark, sf).filter("only_follower").select("user_id")


@register("unknown_ids", oracle=f"WITH {SETS_SQL} SELECT user_id FROM unk")
def unknown_ids(spark: SparkSession, sf: str) -> DataFrame:
    return members(spark, sf).filter("unknown").select("user_id")


@register("unknown_followers", oracle=f"WITH {SETS_SQL} SELECT user_id FROM unkf")
def unknown_followers(spark: SparkSession, sf: str) -> DataFrame:
    return members(spark, sf).filter("unknown_follower").select("user_id")


GATE_SQL = f"""{SETS_SQL},
cnt AS (SELECT (SELECT count(*) FROM fo) AS n_following, (SELECT count(*) FROM fr) AS n_followers,
               (SELECT count(*) FROM dm) AS n_dm_ids, (SELECT count(*) FROM al) AS n_universe,
               (SELECT count(*) FROM unk) AS n_unknown, (SELECT count(*) FROM unkf) AS n_unknown_followers),
gate AS (SELECT *, n_unknown_followers <= {CFG.max_follower_lookup} AS include_followers FROM cnt),
lk AS (SELECT user_id FROM unk WHERE (SELECT include_followers FROM gate)
                                   OR user_id NOT IN (SELECT user_id FROM oo))"""


@register("lookup_gate", oracle=f"""WITH {GATE_SQL}
SELECT CAST(n_following AS BIGINT) AS n_following, CAST(n_followers AS BIGINT) AS n_followers,
       CAST(n_dm_ids AS BIGINT) AS n_dm_ids, CAST(n_universe AS BIGINT) AS n_universe,
       CAST(n_unknown AS BIGINT) AS n_unknown, CAST(n_unknown_followers AS BIGINT) AS n_unknown_followers,
       include_followers, CAST((SELECT count(*) FROM lk) AS BIGINT) AS n_lookup,
       CAST(floor(2.1 * n_unknown_followers) AS BIGINT) AS est_follower_kb
FROM gate""")
def lookup_gate(spark: SparkSession, sf: str) -> DataFrame:
    """One aggregation over the membership table.  The unknown followers are a subset of
    the unknown ids, so the lookup size follows from the counts without another pass."""
    counts = members(spark, sf).agg(
        F.coalesce(F.sum("n_following"), F.lit(0)).alias("n_following"),
        F.coalesce(F.sum("n_followers"), F.lit(0)).alias("n_followers"),
        F.count_if(F.col("n_dm") > 0).alias("n_dm_ids"), F.count_if("in_all").alias("n_universe"),
        F.count_if("unknown").alias("n_unknown"), F.count_if("unknown_follower").alias("n_unknown_followers"))
    include = identity.lookup_gate(F.col("n_unknown_followers"), CFG)
    n_lookup = F.when(include, F.col("n_unknown")).otherwise(F.col("n_unknown") - F.col("n_unknown_followers"))
    return counts.select(*[F.col(c).cast("bigint") for c in counts.columns], include.alias("include_followers"),
                         n_lookup.cast("bigint").alias("n_lookup"),
                         F.floor(F.lit(2.1) * F.col("n_unknown_followers")).cast("bigint").alias("est_follower_kb"))


def lookup_ids(spark, sf) -> DataFrame:
    """The unknown ids to look up; follower-only ones are dropped when the gate (a scalar
    subquery over the unknown-follower count, no cross join) says so."""
    m = members(spark, sf)
    include = identity.lookup_gate(m.agg(F.count_if("unknown_follower")).scalar(), CFG)
    return m.filter(F.col("unknown") & (include | ~F.col("only_follower"))).select("user_id")


@register("following_report", oracle=f"""WITH {SETS_SQL}
SELECT kind, coalesce(us.handle, '{UNKNOWN_HANDLE}') || ' {USER_URL_PREFIX}' || x.user_id AS line
FROM (SELECT 'following' AS kind, user_id FROM fo UNION ALL SELECT 'followers', user_id FROM fr) x
LEFT JOIN us USING (user_id) ORDER BY kind, line""")
def following_report(spark: SparkSession, sf: str) -> DataFrame:
    following, followers, _ = id_sets(spark, sf)
    rows = (following.withColumn("kind", F.lit("following"))
            .unionByName(followers.withColumn("kind", F.lit("followers"))))
    rep = identity.report_lines(rows, users(spark, sf), CFG)
    return rep.select("kind", "line").orderBy("kind", "line")


@register("lookup_batches", oracle=f"""WITH {GATE_SQL},
rn AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY {S.u(['user_id'], 'order')}, user_id) - 1) / {CFG.lookup_batch})
                      AS BIGINT) AS batch FROM lk)
SELECT batch, CAST(count(*) AS BIGINT) AS n_ids, array_to_string(list_sort(list(user_id)), ',') AS ids
FROM rn GROUP BY batch""")
def lookup_batches(spark: SparkSession, sf: str) -> DataFrame:
    b = identity.lookup_batches(lookup_ids(spark, sf), CFG)
    return b.select("batch", F.col("n_ids").cast("bigint"), "ids")


HARVEST_SQL = """obs AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, 'u' || CAST(user_id AS VARCHAR) || '_' || event_type AS handle,
         ts, event_id, 0 AS src FROM events
  UNION ALL
  SELECT CASE WHEN value < 1.0 THEN '-1' ELSE json_extract_string(props, '$.k') END,
         CASE WHEN event_type = 'error' THEN NULL ELSE 'm' || json_extract_string(props, '$.k') || '_' ||
              CAST(event_id AS VARCHAR) END,
         ts, event_id, 1 FROM events)"""


def observations(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    reply = e.select(F.col("user_id").cast("string").alias("user_id"),
                     F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_type")).alias("handle"),
                     F.struct("ts", "event_id", F.lit(0).alias("src")).alias("ord"))
    mention = e.select(F.when(F.col("value") < 1.0, F.lit("-1")).otherwise(k).alias("user_id"),
                       F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                       .otherwise(F.concat(F.lit("m"), k, F.lit("_"), F.col("event_id").cast("string"))).alias("handle"),
                       F.struct("ts", "event_id", F.lit(1).alias("src")).alias("ord"))
    return reply.unionByName(mention)


@register("users_last_write", oracle=f"""WITH {HARVEST_SQL}
SELECT user_id, handle FROM obs WHERE TRY_CAST(user_id AS BIGINT) >= 0 AND handle IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, src DESC) = 1""")
def users_last_write(spark: SparkSession, sf: str) -> DataFrame:
    return identity.harvest_users(observations(spark, sf))
