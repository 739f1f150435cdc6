"""Decisions on postings, pages and registry rows, as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labels of a reviewer that place a posting within reach.
GOOD_LABELS = ("match_global", "match_africa")
QUESTION_MARK = "Application Question:"


def rank_lattice(rows: DataFrame) -> DataFrame:
    """Location priority, clearance and confidence of each row, and whether its URL joins the exclusions.

    Columns: form_ok, result, reason, priority, label, provider, has_question, excluded, rank4, rank4_reason, url.
    Rows are deferred (form unreadable) or dropped where no branch admits them.
    """
    good, unsure = F.col("label").isin(*GOOD_LABELS), F.col("result") == "unsure"
    q = F.col("has_question")
    open_ = unsure & ~F.col("excluded")
    three_a = open_ & (F.col("reason") == "blank") & good
    three_b = open_ & q & F.col("reason").isin("bare_remote", "global_plus_place") & good
    maybe = open_ & q & (F.col("reason") == "bare_remote") & (F.col("label") == "uncertain") & F.col("provider").isNotNull()
    hit = lambda c: F.coalesce(c, F.lit(False))
    branch = (
        F.when(~F.col("form_ok"), "deferred")
        .when(F.col("result") == "match", "match")
        .when(hit(three_a), "3a")
        .when(hit(three_b | maybe), "3b")
        .when(F.col("rank4").isNotNull(), "rank4")
        .otherwise("drop")
    )
    out = rows.withColumn("branch", branch)
    b = F.col("branch")
    who = F.coalesce("provider", F.lit("ai"))
    return (
        out.withColumn("location_priority", F.when(b == "match", F.col("priority")).when(b.isin("3a", "3b"), b).when(b == "rank4", F.col("rank4")))
        .withColumn("clearance", F.when(b == "match", "regex").when(b.isin("3a", "3b"), who).when(b == "rank4", "rank4"))
        .withColumn("confidence", F.when(b == "match", "match").when(b.isin("3a", "3b"), "uncertain").when(b == "rank4", F.col("rank4_reason")))
        .withColumn("exclude", (b == "drop") & hit(open_) & F.col("provider").isNotNull() & (F.coalesce("url", F.lit("")) != ""))
    )


def rank4_gate(rows: Column, role: Column, platform: Column, question: Column, fields: Column, platforms: list[str]) -> Column:
    """Whether the narrow-scope check may run at all."""
    return rows & role.isin("CS", "AM") & platform.isin(*platforms) & (question | (F.coalesce(fields, F.lit(0)) >= 3))


def revalidate(form_failed: Column, clearance: Column, has_marker: Column, rank4_admits: Column, scope: Column, applied: Column) -> Column:
    """veto, keep, undecided or protected (a veto on a row somebody applied to)."""
    verdict = (
        F.when(form_failed & (F.coalesce(clearance, F.lit("")) != "ai_unreviewed"), "undecided")
        .when(clearance == "ai_unreviewed", "veto")
        .when((clearance == "rank4") & ~has_marker, "undecided")
        .when(clearance == "rank4", F.when(rank4_admits, "keep").otherwise("veto"))
        .otherwise(F.when(scope == "no_match", "veto").otherwise("keep"))
    )
    return F.when((verdict == "veto") & (F.coalesce(applied, F.lit("not_applied")) != "not_applied"), "protected").otherwise(verdict)


def stale_first(rows: DataFrame, version: str, current: int, id_: str, cap: int) -> DataFrame:
    """Rows of an older version with due: the oldest versions first, up to the cap; the rest wait for the next run."""
    old = rows.where(F.col(version).isNull() | (F.col(version) < current))
    due = old.orderBy(F.coalesce(version, F.lit(-1)), id_).limit(cap).select(F.col(id_).alias("__id"), F.lit(True).alias("due"))
    return old.join(due, old[id_] == due["__id"], "left").drop("__id").withColumn("due", F.coalesce("due", F.lit(False)))


def plan_of(verdict: Column) -> Column:
    """What a verdict does: veto the row, stamp it with the version, or try it again."""
    return F.when(verdict == "veto", "veto").when(verdict.isin("keep", "protected"), "stamp").otherwise("retry")


def first_tier(hits: DataFrame, domain: str, tier: str, keys: list[str], url: str) -> DataFrame:
    """All hits of each domain's first tier that has any, one per board, its first URL."""
    best = hits.groupBy(domain).agg(F.min(tier).alias("__best"))
    kept = hits.join(best, domain).where(F.col(tier) == F.col("__best")).drop("__best")
    return kept.groupBy(domain, tier, *keys).agg(F.min(url).alias(url))


def lowest_rung(postings: DataFrame, page: str, rung: str) -> DataFrame:
    """Postings of the first extractor that found any on a page."""
    return postings.join(postings.groupBy(page).agg(F.min(rung).alias(rung)), [page, rung], "left_semi")


def merge_detail(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Listing rows with their detail page's longer description, and its location and workplace where they have none."""
    d = detail.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in ("description", "location", "workplace_type")])
    j = listing.join(d, F.col(key) == F.col("__k"), "left")
    longer = F.coalesce(F.length("__description"), F.lit(0)) > F.coalesce(F.length("description"), F.lit(0))
    fill = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}"), F.col(c)).alias(c)
    out = {"description": F.when(longer, F.col("__description")).otherwise(F.col("description")).alias("description"), "location": fill("location"), "workplace_type": fill("workplace_type")}
    return j.select(*[out.get(c, F.col(c)) for c in listing.columns])


#: Kinds of failed fetches that may pass.
TRANSIENT = ("timeout", "connection", "server_error", "rate_limited")


def fetch_failure(status: Column, error: Column) -> Column:
    """Kind of a failed fetch; NULL if it did not fail."""
    e = F.lower(F.coalesce(error, F.lit("")))
    return (
        F.when(e.contains("timeout") | e.contains("timed out"), "timeout")
        .when(e.rlike("dns|name or service|getaddrinfo|nodename"), "dns")
        .when(e.rlike("ssl|certificate"), "ssl")
        .when(e.rlike("too many redirects"), "redirects")
        .when(e.rlike("refused|reset|disconnected|connect"), "connection")
        .when(e != "", "other")
        .when(status == 429, "rate_limited")
        .when(status.isin(401, 403), "blocked")
        .when(status.isin(404, 410), "not_found")
        .when(status >= 500, "server_error")
        .when(status >= 400, "client_error")
    )


def dead_page(page_dead: Column, root_dead: Column) -> Column:
    """Dead only if both page and root are known to be dead; what is unknown keeps a row."""
    return F.coalesce(page_dead, F.lit(False)) & F.coalesce(root_dead, F.lit(False))


def drop_dead(boards: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Boards without those a check found dead; no verdict keeps a board."""
    return boards.join(verdicts.where("dead").select(*keys).distinct(), keys, "left_anti")


def registry_state(verdict: Column, jobs: Column) -> Column:
    return F.when(verdict.isNull(), "unverified").when(~verdict, "dead").when(F.coalesce(jobs, F.lit(0)) > 0, "active").otherwise("empty")


def longest_text(candidates: DataFrame, page: str, url: str, size: str, position: str) -> DataFrame:
    """The candidate with the longest text, the earliest of ties."""
    return candidates.groupBy(page).agg(F.max_by(url, F.struct(F.col(size), (-F.col(position)).alias("p"))).alias(url), F.max(size).alias(size))


#: Labels of location priorities.
RANK_LABELS = {"1": "Global", "2": "EMEA", "3": "Uncertain"}


def rank_label(priority: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in RANK_LABELS.items():
        out = F.when(F.substring(priority, 1, 1) == k, v).otherwise(out)
    return out


def follow_links(seeds: DataFrame, links: DataFrame, per_tier: int = 3, total: int = 5) -> DataFrame:
    """(domain, page, depth) of pages reached from seeds by the best scored links: per_tier in each of two steps, total in all.

    links: (page, target, score, pos). Bounded unrolled joins, a top-k window per domain.
    """
    def step(pages: DataFrame, depth: int) -> DataFrame:
        reached = pages.join(links, "page").select("domain", F.col("target").alias("page"), "score", "pos")
        best = reached.groupBy("domain", "page").agg(F.max("score").alias("score"), F.min("pos").alias("pos"))
        w = Window.partitionBy("domain").orderBy(F.desc("score"), "pos", "page")
        return best.withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_tier).select("domain", "page", F.lit(depth).alias("depth"), "n")

    one = step(seeds, 1)
    two = step(one.select("domain", "page"), 2).join(one.select("domain", "page"), ["domain", "page"], "left_anti")
    w = Window.partitionBy("domain").orderBy("depth", "n")
    return one.unionByName(two).withColumn("k", F.row_number().over(w)).where(F.col("k") <= total).select("domain", "page", "depth")
