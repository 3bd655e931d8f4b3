"""Discovery of attachments in rounds: from an application's page over its document links.

The frontier holds (application, url). In each round its pages are parsed once each, however many applications lead to
them; a page without an attachment leads on to the first of its document links; what an application has seen before is not
looked at again, so that cycles end. A page that very many applications lead to is joined by application and salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraproof.functions import rules as R
from terraproof.operators.attachments import best_attachments, parse_attachments
from terraproof.operators.documents import links, navigation
from terraproof.operators.state import salted_join, shared_folder, written

FOLLOWED, LISTED = 4, 8


def discover(applications: DataFrame, pages: DataFrame, rounds: int = 1, text_pattern: str = R.NAV_TEXT, href_pattern: str = R.NAV_HREF) -> tuple[DataFrame, DataFrame]:
    """(visited, attachments) of ``applications`` (application, url) in ``pages`` (url, html), one page for each url.

    visited: application, url, round in which it is first reached, via (its place among the links that led there), fetched
    (there is such a page). attachments: application and the attachment's columns; of several with one image name the best
    rank, then the first reached. Addresses count as https. Rows without a url are passed over.
    """
    spark = applications.sparkSession
    home = shared_folder(spark, "discovery")
    https = lambda c: F.regexp_replace(c, "(?i)^http:", "https:")
    held = pages.filter("url IS NOT NULL").select(https("url").alias("url"), "html")
    start = applications.filter("application IS NOT NULL AND url IS NOT NULL").select("application", https("url").alias("url")).distinct()
    frontier = written(start.withColumns({"round": F.lit(0), "via": F.lit(0)}), f"{home}/frontier-0")
    visited, found = frontier, None
    for k in range(rounds + 1):
        wanted = frontier.select("url").distinct()
        parsed = written(held.join(wanted, "url", "left_semi").select(F.col("url").alias("page_id"), "url", "html"), f"{home}/pages-{k}")
        each = written(parse_attachments(parsed).withColumnRenamed("url", "image_url").withColumnRenamed("page_id", "url"), f"{home}/attachments-{k}")
        mine = salted_join(frontier, each, "url", "application")
        found = mine if found is None else found.unionByName(mine)
        if k == rounds:
            break
        ways = navigation(links(parsed), text_pattern, href_pattern, LISTED).filter(F.col("rank") <= FOLLOWED)
        ways = ways.join(each.select(F.col("url").alias("page_id")).distinct(), "page_id", "left_anti").select(F.col("page_id").alias("url"), F.col("url").alias("target"), F.col("rank").alias("via"))
        ahead = salted_join(frontier.select("application", "url"), ways, "url", "application").groupBy("application", F.col("target").alias("url")).agg(F.min("via").alias("via"))
        new = ahead.join(visited.select("application", "url"), ["application", "url"], "left_anti")
        frontier = written(new.select("application", "url", F.lit(k + 1).alias("round"), "via"), f"{home}/frontier-{k + 1}")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    there = held.select("url").distinct().withColumn("fetched", F.lit(True))
    seen = visited.join(there, "url", "left").select("application", "url", "round", "via", F.coalesce("fetched", F.lit(False)).alias("fetched"))
    return seen, best_attachments(found.withColumnRenamed("url", "page"), ("round", "via", "page"))
