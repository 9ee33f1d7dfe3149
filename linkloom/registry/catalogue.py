"""Queries on sites, lookups, robots rules and the finished catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.constants import SITE_CONFIDENCE, SITE_INFO
from linkloom.functions import labels as L
from linkloom.operators import lookups, robots, sets, sites
from linkloom.plans import jobs
from linkloom.registry.base import (
    SQL_LINKS,
    label_of,
    link_table,
    query,
    scattered,
    sql_label,
    sql_name,
    sql_netloc,
    sql_norm,
    sql_site,
    sql_strip,
    sql_values,
    table,
)

# Small lookup tables shared by both sides of the check.
NAMES = [("eng", "English"), ("fra", "French"), ("deu", "German")]
SPEAKERS = [(0, "eng", 1500000000.0), (1, "eng", 1.0), (2, "fra", None), (3, "spa", 559000000.0)]
WORLD = [(0, "eng", "English", "1.5B"), (1, "xxx", "FRENCH", "0.3B"), (2, "yyy", "french", "9B"), (3, "deu", "Deutsch", None)]
LANGUOID = [
    (0, "stan1293", "indo1319", "English", "eng"),
    (1, "stan1290", "indo1319", "French", "fra"),
    (2, "stan1288", None, "Spanish", "spa"),
    (3, "indo1319", None, "Indo-European", None),
    (4, "indo1319", None, "Second Entry", None),
]
IN_MADLAD, IN_FLORES, IN_OTHER = ["eng", "fra", None], ["eng_Latn", "deu_Latn"], ["spa_Latn", "eng_Latn", "eng_Latn"]
ISO_CODES = [("en", "eng"), ("fr", "fra"), ("de", "deu"), (None, "ace")]

SQL_NAMES = sql_values("names", "alpha3, name", NAMES)
SQL_SPEAKERS = sql_values("linguameta", "ord, iso, n", SPEAKERS)
SQL_WORLD = sql_values("world", "ord, alpha3, name, speakers", WORLD)
SQL_LANGUOID = sql_values("languoid", "ord, id, family_id, name, iso", LANGUOID)


def _names(spark):
    return spark.createDataFrame(NAMES, "alpha3 string, name string")


def _linguameta(spark):
    return spark.createDataFrame(SPEAKERS, "ord int, iso_639_3_code string, estimated_number_of_speakers double")


def _languoid(spark):
    return spark.createDataFrame(LANGUOID, "ord int, id string, family_id string, name string, iso639P3code string")


def _codes(spark, codes):
    return spark.createDataFrame([(c,) for c in codes], "code string")


def _lists(spark):
    return {
        "madlad": ("code", _codes(spark, IN_MADLAD)),
        "flores": ("lid_label", _codes(spark, IN_FLORES)),
        "listed": ("lid_label", _codes(spark, IN_OTHER)),
    }


def _coded_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", label_of(F.col("lang")).alias("lid_label"))
    return docs.withColumn("code", L.alpha3("lid_label"))


SQL_DOCS = f"""docs AS (SELECT doc_id, {sql_label('lang')} AS lid_label, split_part({sql_label('lang')}, '_', 1) AS code FROM documents)"""


# Lookups.
@query("language_name", f"WITH {SQL_DOCS}, {SQL_NAMES} SELECT doc_id, coalesce(name, code) AS language_name FROM docs LEFT JOIN names ON alpha3 = code")
def language_name(spark, sf_dir):
    return lookups.language_name(_coded_docs(spark, sf_dir), _names(spark)).select("doc_id", "language_name")


SQL_FIRST_SPEAKERS = "first_n AS (SELECT iso, n FROM linguameta QUALIFY row_number() OVER (PARTITION BY iso ORDER BY ord) = 1)"


@query(
    "speakers",
    f"""WITH {SQL_DOCS}, {SQL_SPEAKERS}, {SQL_FIRST_SPEAKERS}
    SELECT doc_id, CAST(n AS DOUBLE) AS speakers, iso IS NOT NULL AS speakers_found FROM docs LEFT JOIN first_n ON iso = code""",
)
def speakers(spark, sf_dir):
    return lookups.speakers(_coded_docs(spark, sf_dir), _linguameta(spark)).select("doc_id", "speakers", "speakers_found")


@query(
    "speakers_fallback",
    f"""WITH {SQL_DOCS}, {SQL_NAMES}, {SQL_WORLD},
    named AS (SELECT doc_id, code, lower(coalesce(n.name, code)) AS k FROM docs LEFT JOIN names n ON n.alpha3 = code),
    by_code AS (SELECT alpha3, speakers FROM world QUALIFY row_number() OVER (PARTITION BY alpha3 ORDER BY ord) = 1),
    by_name AS (SELECT lower(name) AS k, speakers FROM world QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY ord) = 1)
    SELECT doc_id, CASE WHEN c.alpha3 IS NOT NULL THEN c.speakers ELSE b.speakers END AS speakers
    FROM named LEFT JOIN by_code c ON c.alpha3 = code LEFT JOIN by_name b ON b.k = named.k""",
)
def speakers_fallback(spark, sf_dir):
    world = spark.createDataFrame(WORLD, "ord int, alpha3 string, name string, speakers string")
    return lookups.speakers_fallback(_coded_docs(spark, sf_dir), world, _names(spark)).select("doc_id", "speakers")


SQL_FAMILIES = """families AS (
  SELECT c.iso, f.name AS family FROM (SELECT iso, family_id FROM languoid WHERE iso IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY iso ORDER BY ord) = 1) c
    LEFT JOIN (SELECT id, name FROM languoid QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1) f ON f.id = c.family_id)"""


@query("family_name", f"WITH {SQL_DOCS}, {SQL_LANGUOID}, {SQL_FAMILIES} SELECT doc_id, family FROM docs LEFT JOIN families ON iso = code")
def family_name(spark, sf_dir):
    return lookups.family_name(_coded_docs(spark, sf_dir), _languoid(spark)).select("doc_id", "family")


_SQL_FLAGS = """CASE WHEN code IN ('eng', 'fra') THEN 1 ELSE 0 END AS madlad,
  CASE WHEN lid_label IN ('eng_Latn', 'deu_Latn') THEN 1 ELSE 0 END AS flores,
  CASE WHEN lid_label IN ('spa_Latn', 'eng_Latn') THEN 1 ELSE 0 END AS listed"""


@query("support_flags", f"WITH {SQL_DOCS} SELECT doc_id, {_SQL_FLAGS} FROM docs")
def support_flags(spark, sf_dir):
    return lookups.support_flags(_coded_docs(spark, sf_dir), _lists(spark)).select("doc_id", "madlad", "flores", "listed")


@query(
    "bcp_to_iso3",
    f"""WITH {sql_values('iso', 'alpha2, alpha3', ISO_CODES)}, tags AS (
      SELECT doc_id, unnest([lang, lang || '_Latn', source, 'ace_Arab']) AS bcp47 FROM documents),
    known AS (SELECT alpha2 AS k, alpha3 FROM iso WHERE alpha2 IS NOT NULL UNION SELECT alpha3, alpha3 FROM iso)
    SELECT doc_id, bcp47, CASE WHEN length(split_part(bcp47, '_', 1)) IN (2, 3) THEN alpha3 ELSE bcp47 END AS iso3
    FROM tags LEFT JOIN known ON k = split_part(bcp47, '_', 1)""",
)
def bcp_to_iso3(spark, sf_dir):
    iso = spark.createDataFrame(ISO_CODES, "alpha2 string, alpha3 string")
    forms = F.array("lang", F.concat("lang", F.lit("_Latn")), "source", F.lit("ace_Arab"))
    tags = table(spark, sf_dir, "documents").select("doc_id", F.explode(forms).alias("bcp47"))
    return lookups.bcp_to_iso3(tags, iso).select("doc_id", "bcp47", "iso3")


SQL_LANGUAGES = f"""label_set AS (SELECT DISTINCT lid_label, split_part(lid_label, '_', 1) AS code FROM links),
languages AS (SELECT lid_label, coalesce(nm.name, code) AS language_name,
    CASE WHEN s.iso IS NULL THEN 'No data' WHEN s.n IS NULL THEN 'NaN' ELSE CAST(CAST(s.n AS BIGINT) AS VARCHAR) END AS speakers,
    coalesce(family, 'No data') AS family, '' AS subgrouping, {_SQL_FLAGS}
  FROM label_set LEFT JOIN names nm ON nm.alpha3 = code LEFT JOIN first_n s ON s.iso = code LEFT JOIN families f ON f.iso = code)"""
SQL_LANGUAGE_TABLES = f"{SQL_NAMES}, {SQL_SPEAKERS}, {SQL_FIRST_SPEAKERS}, {SQL_LANGUOID}, {SQL_FAMILIES}, {SQL_LANGUAGES}"


def _catalogue(spark, sf_dir):
    return jobs.format_catalogue(
        link_table(spark, sf_dir), _names(spark), _linguameta(spark), _languoid(spark), _lists(spark)
    )


def _printed(languages):
    """Speaker numbers as whole numbers, so that both engines print them alike."""
    number = F.expr("try_cast(speakers AS DOUBLE)")
    whole = F.when(number.isNotNull() & ~F.isnan(number), number.cast("bigint").cast("string"))
    return languages.withColumn("speakers", F.coalesce(whole, "speakers"))


@query("language_catalogue", f"WITH {SQL_LINKS}, {SQL_LANGUAGE_TABLES} SELECT * FROM languages")
def language_catalogue(spark, sf_dir):
    return _printed(_catalogue(spark, sf_dir).languages)


# Sites.
SQL_SITE_LINKS = f"""site_links AS (
  SELECT lid_label, {sql_name(sql_netloc('link'))} AS site_name, {sql_site('link')} AS site_url, ord, link FROM links)"""


@query(
    "group_by_site",
    f"""WITH {SQL_LINKS}, {SQL_SITE_LINKS} SELECT *, row_number() OVER (PARTITION BY lid_label, site_url ORDER BY ord) AS pos
    FROM site_links""",
)
def group_by_site(spark, sf_dir):
    return sites.site_positions(sites.group_by_site(link_table(spark, sf_dir)))


@query(
    "group_by_site_sparse",
    f"""WITH {SQL_LINKS}, {SQL_SITE_LINKS}, scattered AS (SELECT * REPLACE (ord * 1000003 % 2147483647 AS ord) FROM site_links)
    SELECT *, row_number() OVER (PARTITION BY lid_label, site_url ORDER BY ord) AS pos FROM scattered""",
)
def group_by_site_sparse(spark, sf_dir):
    """Places by scattered order values."""
    links = link_table(spark, sf_dir).withColumn("ord", scattered(F.col("ord")))
    return sites.site_positions(sites.group_by_site(links))


@query(
    "catalogue_sites",
    f"""WITH {SQL_LINKS}, {SQL_SITE_LINKS} SELECT lid_label, site_name, site_url, min(ord) AS first_ord, count(*) AS n_links,
      '{SITE_INFO}' AS info, '{SITE_CONFIDENCE}' AS confidence FROM site_links GROUP BY lid_label, site_name, site_url""",
)
def catalogue_sites(spark, sf_dir):
    return _catalogue(spark, sf_dir).sites()


@query("domain_distribution", f"WITH {SQL_LINKS}, {SQL_SITE_LINKS} SELECT lid_label, site_url, count(*) AS n_links FROM site_links GROUP BY ALL")
def domain_distribution(spark, sf_dir):
    return sites.domain_distribution(sites.group_by_site(link_table(spark, sf_dir)))


def sql_merged(source: str) -> str:
    return f"""sites AS (SELECT lid_label, site_name, site_url, min(ord) AS first_ord, {sql_norm('site_url')} AS norm
    FROM {source} GROUP BY lid_label, site_name, site_url),
  groups AS (SELECT lid_label, site_name, norm, count(*) AS n,
    first(site_url ORDER BY CASE WHEN site_url LIKE 'https%' THEN 0 ELSE 1 END, first_ord) AS base FROM sites GROUP BY ALL),
  placed AS (SELECT l.lid_label, l.site_name, g.base AS site_url, g.n, l.ord, l.link FROM {source} l
    JOIN sites s ON s.lid_label = l.lid_label AND s.site_url = l.site_url
    JOIN groups g ON g.lid_label = s.lid_label AND g.site_name = s.site_name AND g.norm = s.norm),
  merged AS (SELECT lid_label, site_name, site_url, ord, link FROM placed WHERE n = 1
    UNION ALL SELECT DISTINCT lid_label, site_name, site_url, CAST(NULL AS BIGINT), link FROM placed WHERE n > 1)"""


SQL_MERGED = sql_merged("site_links")


@query("merge_sites", f"WITH {SQL_LINKS}, {SQL_SITE_LINKS}, {SQL_MERGED} SELECT * FROM merged")
def merge_sites(spark, sf_dir):
    return sites.merge_sites(sites.group_by_site(link_table(spark, sf_dir)))


SQL_DEDUPED = f"""deduped AS (SELECT lid_label, site_name, site_url, ord, link AS first_link, {sql_strip('link')} AS clean FROM merged
  QUALIFY row_number() OVER (PARTITION BY lid_label, site_name, site_url, {sql_strip('link')} ORDER BY ord NULLS FIRST, link) = 1)"""


def _deduped(spark, sf_dir, strip):
    merged = sites.merge_sites(sites.group_by_site(link_table(spark, sf_dir)))
    return sites.dedup_fragments(merged, strip).select(*sites.SITE_COLUMNS)


_DEDUP_SQL = "WITH {}, {}, {}, {} SELECT lid_label, site_name, site_url, ord, {} AS link FROM deduped"


@query("dedup_fragment_strip", _DEDUP_SQL.format(SQL_LINKS, SQL_SITE_LINKS, SQL_MERGED, SQL_DEDUPED, "clean"))
def dedup_fragment_strip(spark, sf_dir):
    return _deduped(spark, sf_dir, True)


@query("dedup_fragment_keep", _DEDUP_SQL.format(SQL_LINKS, SQL_SITE_LINKS, SQL_MERGED, SQL_DEDUPED, "first_link"))
def dedup_fragment_keep(spark, sf_dir):
    return _deduped(spark, sf_dir, False)


# Robots texts: one per site, of a form that its first page picks.
FORMS = [
    "User-agent: CCBot\nDisallow: /x\nDisallow: /\n",
    "User-agent: CCBot\r\nUser-agent: Foo\r\nDisallow: /",
    "user-agent: CCBot\nDisallow: /",
    "User-agent: CCBot\nAllow: /\nDisallow: /",
    "User-agent: *\nDisallow: /\nUser-agent: CCBot\n  Disallow:  /  \n",
    "User-agent: CCBot\nDisallow: / # all",
    "",
]


def _robots(spark, sf_dir):
    found = sites.group_by_site(link_table(spark, sf_dir)).groupBy("site_url").agg(F.min("ord").alias("o"))
    form = F.get(F.array(*map(F.lit, FORMS)), (F.col("o") % 9).cast("int"))
    # Two of nine sites have no robots text.
    return found.select("site_url", form.alias("robots_txt")).filter(F.col("robots_txt").isNotNull())


_FORM_SQL = " ".join(
    "WHEN {} THEN {}".format(i, " || ".join(
        "chr(10)" if part == "\n" else "chr(13)" if part == "\r" else f"'{part}'"
        for part in form.replace("\r", "\0\r\0").replace("\n", "\0\n\0").split("\0") if part
    ) or "''")
    for i, form in enumerate(FORMS)
)
SQL_ROBOTS = f"""robots AS (SELECT * FROM (
    SELECT site_url, CASE min(ord) % 9 {_FORM_SQL} END AS robots_txt FROM site_links GROUP BY site_url) WHERE robots_txt IS NOT NULL),
  lines AS (SELECT site_url, unnest(l) AS raw, unnest(range(len(l))) AS pos FROM (
    SELECT site_url, string_split(replace(robots_txt, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM robots)),
  fields AS (SELECT site_url, pos, trim(raw) AS line, trim(split_part(trim(raw), ':', 2)) AS value FROM lines),
  spoken AS (SELECT *, last_value(CASE WHEN line LIKE 'User-agent:%' THEN value END IGNORE NULLS)
    OVER (PARTITION BY site_url ORDER BY pos) AS agent FROM fields),
  decisive AS (SELECT site_url, first(line LIKE 'Disallow:%' ORDER BY pos) AS blocked FROM spoken
    WHERE agent = 'CCBot' AND value = '/' AND (line LIKE 'Disallow:%' OR line LIKE 'Allow:%') GROUP BY site_url),
  verdicts AS (SELECT r.site_url, coalesce(d.blocked, false) AS blocked FROM robots r LEFT JOIN decisive d USING (site_url))"""


@query("robots_verdict", f"WITH {SQL_LINKS}, {SQL_SITE_LINKS}, {SQL_ROBOTS} SELECT site_url, blocked FROM verdicts")
def robots_verdict(spark, sf_dir):
    return robots.robots_verdict(_robots(spark, sf_dir))


SQL_ALLOWED = "allowed AS (SELECT * FROM site_links WHERE site_url NOT IN (SELECT site_url FROM verdicts WHERE blocked))"


@query("robots_filter", f"WITH {SQL_LINKS}, {SQL_SITE_LINKS}, {SQL_ROBOTS}, {SQL_ALLOWED} SELECT * FROM allowed")
def robots_filter(spark, sf_dir):
    return robots.robots_filter(sites.group_by_site(link_table(spark, sf_dir)), _robots(spark, sf_dir))


@query(
    "clean_catalogue",
    f"""WITH {SQL_LINKS}, {SQL_SITE_LINKS}, {SQL_ROBOTS}, {SQL_ALLOWED}, {sql_merged('allowed')}, {SQL_DEDUPED}, {SQL_LANGUAGE_TABLES}
    SELECT lid_label, language_name, family, site_name, site_url, count(*) AS n_links, min(clean) AS first_link
    FROM deduped JOIN languages USING (lid_label) GROUP BY ALL""",
)
def clean_catalogue(spark, sf_dir):
    cleaned = jobs.clean_catalogue(_catalogue(spark, sf_dir), _robots(spark, sf_dir))
    return per_site(cleaned.site_links, cleaned.languages)


def per_site(site_links, languages):
    grouped = site_links.groupBy("lid_label", "site_name", "site_url").agg(
        F.count(F.lit(1)).alias("n_links"), F.min("link").alias("first_link")
    )
    return grouped.join(languages.select("lid_label", "language_name", "family"), "lid_label").select(
        "lid_label", "language_name", "family", "site_name", "site_url", "n_links", "first_link"
    )


@query(
    "report",
    f"""WITH {SQL_LINKS}, {SQL_LANGUAGE_TABLES},
    s AS (SELECT lid_label, link AS url FROM links WHERE link LIKE 'https:%'),
    f AS (SELECT DISTINCT lid_label, link AS url FROM links WHERE NOT contains(link, '#')),
    rejected AS (SELECT * FROM s EXCEPT SELECT * FROM f), active AS (SELECT * FROM s EXCEPT SELECT * FROM rejected),
    fresh AS (SELECT * FROM f EXCEPT SELECT * FROM s),
    lens AS (SELECT {sql_label('lang')} AS lid_label, sum(length(text)) AS text_len FROM documents GROUP BY 1)
    SELECT lid_label AS alpha_3_code, language_name, speakers AS num_speakers, family, madlad, flores, listed,
      CAST(text_len AS BIGINT) AS text_len,
      (SELECT count(*) FROM active a WHERE a.lid_label = l.lid_label) AS active_seed_urls,
      (SELECT count(*) FROM f WHERE f.lid_label = l.lid_label) AS acquired_urls,
      (SELECT count(*) FROM fresh n WHERE n.lid_label = l.lid_label) AS newly_discovered_urls
    FROM languages l LEFT JOIN lens USING (lid_label)""",
)
def report(spark, sf_dir):
    links = link_table(spark, sf_dir).select("lid_label", F.col("link").alias("url"))
    seeds = links.filter(F.startswith("url", F.lit("https:")))
    filtered = links.filter(~F.contains("url", F.lit("#"))).distinct()
    metadata = sets.add_active_seeds(sets.crawl_metadata(seeds, links, filtered))
    texts = table(spark, sf_dir, "documents").select(label_of(F.col("lang")).alias("lid_label"), "text")
    return jobs.report(_printed(_catalogue(spark, sf_dir).languages), metadata, ["madlad", "flores", "listed"], texts)
