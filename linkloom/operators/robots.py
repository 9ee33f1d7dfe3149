"""Robots rules: verdict per site and the gate on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.constants import ROBOTS_AGENT
from linkloom.functions.text import strip


def is_blocked(robots_txt: Column | str, agent: str = ROBOTS_AGENT) -> Column:
    """Whether a robots text shuts the agent out of ``/``.

    The last ``User-agent:`` line above a rule names its agent (case and spelling
    exact, no grouping). The first ``Disallow: /`` or ``Allow: /`` of the agent
    decides; only the text between the first two colons counts. A row-local walk
    over the lines, so a robots table is judged without a shuffle.
    """
    text = F.col(robots_txt) if isinstance(robots_txt, str) else robots_txt
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x{0b}\f\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"), strip)
    start = F.struct(F.lit("").alias("agent"), F.lit(None).cast("boolean").alias("blocked"))

    def step(state: Column, line: Column) -> Column:
        value = strip(F.get(F.split(line, ":"), F.lit(1)))
        names_agent = F.startswith(line, F.lit("User-agent:"))
        decides = (
            state["blocked"].isNull()
            & (state["agent"] == agent)
            & (F.startswith(line, F.lit("Disallow:")) | F.startswith(line, F.lit("Allow:")))
            & (value == "/")
        )
        return F.struct(
            F.when(names_agent, value).otherwise(state["agent"]).alias("agent"),
            F.when(decides, F.startswith(line, F.lit("Disallow:"))).otherwise(state["blocked"]).alias("blocked"),
        )

    verdict = F.aggregate(lines, start, step, lambda state: F.coalesce(state["blocked"], F.lit(False)))
    return F.coalesce(verdict, F.lit(False))


def robots_verdict(robots: DataFrame, agent: str = ROBOTS_AGENT) -> DataFrame:
    return robots.select("site_url", is_blocked("robots_txt", agent).alias("blocked"))


def robots_filter(site_links: DataFrame, robots: DataFrame, agent: str = ROBOTS_AGENT) -> DataFrame:
    """Drop the sites that shut the agent out; a site without robots text stays."""
    shut = robots.filter(is_blocked("robots_txt", agent)).select("site_url").distinct()
    return site_links.join(shut, "site_url", "left_anti").select(*site_links.columns)
