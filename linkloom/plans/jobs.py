"""The jobs users call: compositions of the operators, lazy up to their sinks.

Every job works on all labels at once; the label is a key of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from linkloom.constants import (
    BLOCKLIST,
    GROWTH_FACTOR,
    MAX_PAGES,
    MAX_URL_LENGTH,
    MIN_CONFIDENCE,
    NGRAM_ORDER,
    ROBOTS_AGENT,
    SEED_KEYS,
    SITE_CONFIDENCE,
    SITE_INFO,
)
from linkloom.operators import filters, frontier, lid, lm, lookups, robots, sampling, sets, sites
from linkloom.session import stored
from linkloom.sinks import files, nested, runs
from linkloom.sources import seeds as seed_sources


def search_language_filter(
    results: DataFrame,
    pages: DataFrame,
    predictor: lid.Predictor,
    excluded: DataFrame | list[str],
    blocklist: list[str] | DataFrame = list(BLOCKLIST),
    path: str | None = None,
    label: str = "predicted_lid",
    run: str | None = None,
    **options,
) -> DataFrame:
    """Search results whose page is in a language off the excluded list, filed by language.

    ``label='iso_code'`` files them by the query's language. ``source='stripped'``
    judges all visible text of a page, and ``drop_empty`` leaves out pages with none. A named
    ``run`` is filed once, however often it is repeated; ``runs.read_runs`` reads what is filed so.
    """
    kept = lid.language_filter(filters.blocklist_filter(results, blocklist), pages, predictor, excluded, **options)
    if path and run is not None:
        runs.append_run(kept, path, run, label)
    elif path:
        files.append_by_label(kept, path, label)
    return kept


@dataclass
class Expansion:
    """Outcome of a seed expansion."""

    visits: DataFrame
    crawled: DataFrame
    metadata: DataFrame


def expand_seeds(
    entries: DataFrame,
    pages: DataFrame,
    predictor: lid.Predictor,
    minimum: float = MIN_CONFIDENCE,
    blocklist: list[str] | DataFrame = list(BLOCKLIST),
    max_pages: int = MAX_PAGES,
    growth_factor: float | None = GROWTH_FACTOR,
    max_url_length: int = MAX_URL_LENGTH,
    required: tuple[str, ...] = SEED_KEYS,
    save_text: bool = True,
    path: str | None = None,
    source: str = "main",
    **options,
) -> Expansion:
    """Seeds of all labels, crawled over the page table and judged by language.

    ``entries`` is (lid_label, link, lid_confidence, ...). A label without a
    seed above the minimum yields no output. Seeds are judged like found links.
    """
    valid = seed_sources.valid_seeds(entries, required)
    allowed = filters.blocklist_filter(valid, blocklist)
    seeds = stored(filters.seed_gate(allowed, minimum).select("lid_label", F.col("link").alias("url")), "seeds")
    # Each page of the seeds' sites is parsed once, for its links and its text, whatever the number of levels and labels.
    parsed = stored(frontier.parsed_site_pages(pages, seeds, source), "parsed")
    edges = parsed.select(F.col("link").alias("src"), F.explode("links").alias("dst"))
    crawl = frontier.crawl(seeds, edges, ["lid_label"], max_pages, growth_factor, max_url_length)
    links = stored(crawl.all_links.withColumnRenamed("url", "link"), "links")
    crawled = stored(lid.filter_links(links, parsed.select("link", "text"), predictor, minimum, save_text, **options), "crawled")
    metadata = sets.crawl_metadata(
        seeds,
        links.withColumnRenamed("link", "url"),
        crawled.select("lid_label", F.col("link").alias("url")),
    )
    if path:
        files.overwrite_by_label(crawled, f"{path}/crawled")
        files.write_metadata(metadata, f"{path}/meta_data")
    return Expansion(crawl.visits, crawled, metadata)


def final_filter(
    crawled: DataFrame, metadata: DataFrame, blocklist: list[str] | DataFrame = list(BLOCKLIST), path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Blocklist once more on results and metadata, then the seeds that stay active."""
    kept = filters.blocklist_filter(crawled, blocklist)
    lists = sets.add_active_seeds(filters.filter_metadata(metadata, blocklist))
    if path:
        files.overwrite_by_label(kept, f"{path}/crawled")
        files.write_metadata(lists, f"{path}/meta_data")
    return kept, lists


@dataclass
class Catalogue:
    """Language entries (one row per label) and their site links (one row per link)."""

    languages: DataFrame
    site_links: DataFrame

    def sites(self, info: str = SITE_INFO, confidence: str = SITE_CONFIDENCE) -> DataFrame:
        """One row per site with its constants and the number of its links."""
        return (
            self.site_links.groupBy("lid_label", "site_name", "site_url")
            .agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n_links"))
            .withColumn("info", F.lit(info))
            .withColumn("confidence", F.lit(confidence))
        )

    def write_nested(self, path: str, info: str = SITE_INFO, confidence: str = SITE_CONFIDENCE) -> None:
        """One nested JSON document for each label, in ordered files."""
        nested.write_nested(self.languages, self.site_links, path, info, confidence)


def _filed(catalogue: Catalogue, path: str | None) -> Catalogue:
    if path:
        files.write_catalogue(catalogue.languages, catalogue.site_links, path)
    return catalogue


def format_catalogue(
    crawled: DataFrame,
    names: DataFrame,
    linguameta: DataFrame,
    languoid: DataFrame,
    lists: dict,
    path: str | None = None,
) -> Catalogue:
    """Catalogue of crawled links (lid_label, ord, link) with language metadata.

    Labels that are not of the form ``code_Script`` have no entry: ``lookups.odd_labels`` names them.
    """
    labels = crawled.select("lid_label").distinct()
    languages = lookups.language_catalogue(labels, names, linguameta, languoid, lists)
    return _filed(Catalogue(languages, sites.group_by_site(crawled)), path)


def comply_with_robots(
    catalogue: Catalogue, robots_texts: DataFrame, agent: str = ROBOTS_AGENT, path: str | None = None
) -> Catalogue:
    kept = robots.robots_filter(catalogue.site_links, robots_texts, agent)
    return _filed(Catalogue(catalogue.languages, kept), path)


def merge_protocols(catalogue: Catalogue, path: str | None = None) -> Catalogue:
    return _filed(Catalogue(catalogue.languages, sites.merge_sites(catalogue.site_links)), path)


def dedup_catalogue(catalogue: Catalogue, strip: bool = True, path: str | None = None) -> Catalogue:
    kept = sites.dedup_fragments(catalogue.site_links, strip).select(*sites.SITE_COLUMNS)
    return _filed(Catalogue(catalogue.languages, kept), path)


def clean_catalogue(catalogue: Catalogue, robots_texts: DataFrame, strip: bool = True, path: str | None = None) -> Catalogue:
    """Robots gate, protocol merge and fragment dedup in one chain."""
    return dedup_catalogue(merge_protocols(comply_with_robots(catalogue, robots_texts)), strip, path)


def report(languages: DataFrame, metadata: DataFrame, flags: list[str], texts: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """One row per label that has both a catalogue entry and crawl metadata."""
    counted = sets.crawl_stats(metadata)
    joined = languages.join(counted, "lid_label")
    if texts is not None:
        joined = joined.join(lm.corpus_lengths(texts), "lid_label", "left")
    else:
        joined = joined.withColumn("text_len", F.lit(None).cast("bigint"))
    out = joined.select(
        F.col("lid_label").alias("alpha_3_code"),
        "language_name",
        F.col("speakers").alias("num_speakers"),
        "family",
        *flags,
        "text_len",
        F.col("active_seed_urls_len").alias("active_seed_urls"),
        F.col("filtered_links_len").alias("acquired_urls"),
        F.col("unique_links_len").alias("newly_discovered_urls"),
    )
    if path:
        files.write_report(out, path)
    return out


def sample_seeds(corpus: DataFrame, entries: DataFrame, n: int = 2, path: str | None = None) -> DataFrame:
    """(iso_code, transcription): per language the rows closest to its median length.

    ``corpus`` is (ord, glottocode, transcription), ``entries`` is (id, identifiers).
    """
    coded = filters.drop_empty(lookups.add_iso(corpus, lookups.glotto_iso_map(entries)))
    sample = sampling.median_sample(coded, n=n).select("iso_code", "transcription")
    if path:
        files.write_delimited(sample, path, sep="\t", header=False)
    return sample


def build_language_models(
    documents: DataFrame,
    labels: list[str] | None = None,
    order: int = NGRAM_ORDER,
    path: str | None = None,
    sentence_is: str = "document",
    tokenizer=None,
) -> DataFrame:
    """Corpora cut to equal length, counted by character and smoothed; one model per label.

    ``labels`` limits the work to some labels. A ``tokenizer`` (column to column) is applied to the
    texts first; blanks never count, so ``char_tokenize`` changes nothing.
    """
    corpus = lm.truncate_to_shortest(lm.label_corpus(documents, labels))
    if tokenizer is not None:
        corpus = lm.tokenize_corpus(corpus, tokenizer)
    counts = stored(lm.ngram_counts(corpus, order, sentence_is), "counts", ("n",))
    model = stored(lm.kn_model(counts, order), "model", ("n",))
    if path:
        files.write_sorted_text(lm.arpa_lines(model, order), path, ["section", "part"])
    return model
