"""Queries of the channel clustering."""

from pyspark.sql import functions as F

from clicksieve.operators import cluster
from clicksieve.queries.base import CHECKS, HIST, checks, ctes, hist, query, rounded
from clicksieve.session import cut_lineage

KEYS = ["de", "en", "es", "fr"]

# Channels of the judged rows with two tags and their volume.
CHANNELS = """chan AS (
  SELECT site, srcg, ctype, count(*) spv, CASE WHEN avg(l_quantity) > 25.5 THEN 'big' ELSE 'small' END qty_tag,
         CASE WHEN avg(l_discount) > 0.05 THEN 1 ELSE 0 END disc_tag
  FROM checks GROUP BY site, srcg, ctype)"""


def _channels(spark, folder):
    """The group frame as a table: clustering reads it several times."""
    return cut_lineage(checks(spark, folder).groupBy("site", "srcg", "ctype").agg(
        F.count(F.lit(1)).alias("spv"),
        F.when(F.avg("l_quantity") > 25.5, "big").otherwise("small").alias("qty_tag"),
        F.when(F.avg("l_discount") > 0.05, 1).otherwise(0).alias("disc_tag")))


def _histograms(spark, folder):
    return cut_lineage(hist(spark, folder))


@query("histogram_vectors", ctes(HIST) + """
, f AS (SELECT g.grp, ks.k, coalesce(n, 0) n FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN (SELECT DISTINCT k FROM hist) ks
   LEFT JOIN hist ON hist.grp = g.grp AND hist.k = ks.k)
SELECT grp, string_agg(CAST(n AS VARCHAR), ',' ORDER BY k) vec FROM f GROUP BY grp""")
def histogram_vectors(spark, folder):
    out = cluster.histogram_vectors(_histograms(spark, folder), "grp")
    return out.select("grp", F.array_join(F.col("vec").cast("array<bigint>").cast("array<string>"), ",").alias("vec"))


@query("histogram_places", ctes(HIST) + """
, ks AS (SELECT k, row_number() OVER (ORDER BY k) - 1 place FROM (SELECT DISTINCT k FROM hist))
SELECT grp, k, place, n FROM hist JOIN ks USING (k)""")
def histogram_places(spark, folder):
    return cluster.histogram_places(_histograms(spark, folder), "grp")


_DIST = """, f AS (SELECT g.grp, ks.k, coalesce(n, 0) + 0.0001 n FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN (SELECT DISTINCT k FROM hist) ks
   LEFT JOIN hist ON hist.grp = g.grp AND hist.k = ks.k)
, p AS (SELECT grp, k, CAST(n AS DOUBLE) / sum(CAST(n AS DOUBLE)) OVER (PARTITION BY grp) p FROM f)
, dist AS (SELECT a.grp a, b.grp b, sum(a.p * ln(a.p / b.p)) kl FROM p a JOIN p b ON a.k = b.k AND a.grp <> b.grp GROUP BY ALL)"""


@query("near_pairs", ctes(HIST) + _DIST + " SELECT a, b, round(kl, 6) kl FROM dist WHERE kl < 0.05")
def near_pairs(spark, folder):
    out = cluster.near_pairs(_histograms(spark, folder), "grp", below=0.05)
    return out.select("a", "b", rounded("kl"))


@query("pairwise_kl", ctes(HIST) + _DIST + " SELECT a, b, round(kl, 6) kl FROM dist")
def pairwise_kl(spark, folder):
    out = cluster.pairwise_kl(_histograms(spark, folder), "grp")
    return out.select("a", "b", rounded("kl"))


_LINK = """
, v AS (SELECT grp, sum(n) volume FROM hist GROUP BY grp)
, one AS (SELECT dist.a, dist.b, kl FROM dist JOIN v x ON x.grp = a JOIN v y ON y.grp = b
          WHERE x.volume > y.volume OR (x.volume = y.volume AND a < b))
, rounds AS (
  SELECT 0 step, grp, grp tag FROM v
  UNION ALL
  SELECT step + 1, grp, coalesce(new, tag) FROM (
    WITH means AS (
      SELECT least(x.tag, y.tag) lo, greatest(x.tag, y.tag) hi, avg(kl) d
      FROM one JOIN rounds x ON x.grp = one.a JOIN rounds y ON y.grp = one.b WHERE x.tag <> y.tag GROUP BY ALL)
    , nearest AS (
      SELECT own, arg_min(struct_pack(lo := lo, hi := hi), struct_pack(d := d, lo := lo, hi := hi)) p, min(d) d FROM (
        SELECT lo own, lo, hi, d FROM means UNION ALL SELECT hi, lo, hi, d FROM means) GROUP BY own)
    , merges AS (SELECT p.lo AS new, p.hi AS old FROM nearest WHERE d < 0.02 GROUP BY p HAVING count(*) = 2)
    SELECT r.step, r.grp, r.tag, m.new FROM rounds r LEFT JOIN merges m ON m.old = r.tag
    WHERE (SELECT count(*) FROM merges) > 0))
SELECT grp, tag FROM rounds WHERE step = (SELECT max(step) FROM rounds)"""


@query("average_link_clusters", ctes(HIST).replace("WITH", "WITH RECURSIVE", 1) + _DIST + _LINK)
def average_link_clusters(spark, folder):
    rows = _histograms(spark, folder)
    sizes = rows.groupBy("grp").agg(F.sum("n").alias("volume"))
    return cluster.average_link_histograms(rows, sizes, "grp", "volume", 0.02)


@query("cluster_stats", ctes(HIST) + _DIST + """
, v AS (SELECT grp, sum(n) volume, CASE WHEN sum(n) FILTER (k = 'en') * 2 >= sum(n) THEN 'english' ELSE 'mixed' END tag FROM hist GROUP BY grp)
, fz AS (SELECT g.grp, ks.k, coalesce(n, 0) n FROM (SELECT DISTINCT grp FROM hist) g CROSS JOIN (SELECT DISTINCT k FROM hist) ks
   LEFT JOIN hist ON hist.grp = g.grp AND hist.k = ks.k)
, dn AS (SELECT va.tag, avg(kl) dens FROM dist JOIN v va ON va.grp = a JOIN v vb ON vb.grp = b WHERE a > b AND va.tag = vb.tag GROUP BY va.tag)
, sz AS (SELECT tag, count(*) nodes, CAST(sum(volume) AS BIGINT) volume FROM v GROUP BY tag)
SELECT v.tag, k, round(avg(n), 6) mean, round(stddev_pop(n), 6) std, any_value(nodes) nodes, any_value(sz.volume) volume,
       round(coalesce(any_value(dens), 0), 6) density
FROM fz JOIN v USING (grp) JOIN sz ON sz.tag = v.tag LEFT JOIN dn ON dn.tag = v.tag GROUP BY v.tag, k""")
def cluster_stats(spark, folder):
    rows = _histograms(spark, folder)
    english = rows.groupBy("grp").agg(
        F.coalesce(F.sum(F.when(F.col("k") == "en", F.col("n"))), F.lit(0)).alias("e"), F.sum("n").alias("volume"))
    members = english.select(
        "grp", "volume", F.when(F.col("e") * 2 >= F.col("volume"), "english").otherwise("mixed").alias("tag"))
    out = cluster.cluster_stats(members, rows, "grp", "tag", "volume", KEYS)
    return out.select("tag", "k", rounded("mean"), rounded("std"), "nodes", "volume", rounded("density"))


@query("sort_by_volume", ctes(CHECKS, CHANNELS) + "SELECT site, srcg, ctype, spv FROM chan WHERE spv >= 480")
def sort_by_volume(spark, folder):
    out = cluster.sort_by_volume(_channels(spark, folder), "spv", 480, ["site", "srcg", "ctype"])
    return out.select("site", "srcg", "ctype", "spv")


@query("rank_clusters", ctes(CHECKS, CHANNELS) + """
SELECT qty_tag, count(*) channels, CAST(sum(spv) AS BIGINT) volume, round(avg(spv), 6) average FROM chan GROUP BY qty_tag""")
def rank_clusters(spark, folder):
    return cluster.rank_clusters(_channels(spark, folder), "qty_tag", "spv", "avg").withColumn(
        "average", F.round("average", 6))


@query("best_tag_path", ctes(CHECKS, CHANNELS) + """
, p AS (SELECT qty_tag, disc_tag, count(*) channels, CAST(sum(spv) AS BIGINT) volume, avg(spv) average FROM chan GROUP BY ALL
        ORDER BY volume DESC, qty_tag, disc_tag LIMIT 3)
, s AS (SELECT qty_tag, disc_tag, srcg, CAST(sum(spv) AS BIGINT) site_volume FROM chan GROUP BY ALL)
SELECT qty_tag, disc_tag, channels, volume, round(average, 6) average, srcg, site_volume,
  CAST(row_number() OVER (PARTITION BY qty_tag, disc_tag ORDER BY site_volume DESC, srcg) AS INTEGER) site_rank
FROM p JOIN s USING (qty_tag, disc_tag) QUALIFY site_rank <= 3""")
def best_tag_path(spark, folder):
    out = cluster.best_tag_path(_channels(spark, folder), ["qty_tag", "disc_tag"], "srcg", "spv", "pv", 3)
    return out.withColumn("average", F.round("average", 6))


@query("keep_one_per_page", "WITH RECURSIVE " + CHECKS + ", " + CHANNELS + """
, c AS (SELECT CASE WHEN srcg = 's0' THEN 'unk' ELSE ctype END site, concat(site, '#', srcg) srcg, spv FROM chan)
, o AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY spv DESC, srcg) r FROM c WHERE site <> 'unk')
, w AS (SELECT site, srcg, spv, r, spv anchor FROM o WHERE r = 1
   UNION ALL SELECT o.site, o.srcg, o.spv, o.r, CASE WHEN abs((o.spv - w.anchor) / (o.spv + w.anchor)::DOUBLE) < 0.01 THEN w.anchor ELSE o.spv END
   FROM w JOIN o ON o.site = w.site AND o.r = w.r + 1)
, l AS (SELECT site, srcg, spv, r = max(r) OVER (PARTITION BY site, anchor) keep FROM w)
SELECT site, srcg, spv FROM l WHERE keep UNION ALL SELECT site, srcg, spv FROM c WHERE site = 'unk'""")
def keep_one_per_page(spark, folder):
    rows = _channels(spark, folder).select(
        F.when(F.col("srcg") == "s0", "unk").otherwise(F.col("ctype")).alias("site"),
        F.concat_ws("#", "site", "srcg").alias("srcg"), "spv")
    return cluster.keep_one_per_page(rows, "site", "srcg", "spv")
