"""Character n-gram language models by interpolated modified Kneser-Ney smoothing.

Chen & Goodman (1999), Heafield et al. (2013). Each document is one sentence.
Inside the tables an n-gram is packed as ``gram``: a string of n characters, one
per token, with code points set aside for the sentence marks. Context and suffix
are then substrings. All labels are modelled together; tables are keyed by label.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.constants import NGRAM_ORDER
from linkloom.functions.text import char_ngrams, char_tokenize, squeeze, truncate
from linkloom.operators.grams import count_runs
from linkloom.operators.ordering import position, running_total
from linkloom.session import stored

BEGIN, END, UNKNOWN = "<s>", "</s>", "<unk>"

# Noncharacters, which no text for interchange holds, stand for the marks inside packed n-grams.
_BEGIN, _END, _UNKNOWN = "\ufdd0", "\ufdd1", "\ufdd2"


def shown(gram: Column | str) -> Column:
    """Packed n-gram as tokens joined by blanks."""
    text = F.array_join(F.split(gram, ""), " ")
    for packed, mark in ((_BEGIN, BEGIN), (_END, END), (_UNKNOWN, UNKNOWN)):
        text = F.replace(text, F.lit(packed), F.lit(mark))
    return text


def label_corpus(documents: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(lid_label, doc_id, text) of the wanted labels with the text's length."""
    chosen = documents if labels is None else documents.filter(F.col("lid_label").isin(labels))
    return chosen.filter(F.col("text").isNotNull()).select(
        "lid_label", "doc_id", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def corpus_lengths(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("lid_label").agg(F.sum(F.length("text").cast("bigint")).alias("text_len"))


def truncate_to_shortest(corpus: DataFrame) -> DataFrame:
    """Cut every label's corpus, in document order, to the length of the shortest one."""
    # Lengths alone are run up. They meet their texts by a mark of the row, as ids may repeat and ids and labels be null.
    marked = stored(corpus.select("lid_label", "doc_id", "text").withColumn("mark", F.monotonically_increasing_id()), "marked")
    sizes = marked.select("lid_label", "doc_id", "mark", F.length("text").cast("bigint").alias("size"))
    measured = running_total(sizes, ["lid_label"], "doc_id", F.col("size"), "upto")
    least = sizes.groupBy("lid_label").agg(F.sum("size").alias("n")).agg(F.min("n").alias("n")).scalar()
    kept = measured.withColumn("room", least - (F.col("upto") - F.col("size"))).filter("room > 0")
    return (
        marked.join(kept.select("mark", "room"), "mark")
        .select("lid_label", "doc_id", cut_to("text", F.col("room")).alias("text"))
    )


def cut_to(text: str, room: Column) -> Column:
    """The first ``room`` characters; ``room`` may be beyond what a text can hold."""
    return truncate(text, F.least(room, F.length(text)).cast("int"))


def tokenize_corpus(corpus: DataFrame, tokenizer=char_tokenize) -> DataFrame:
    return corpus.withColumn("text", tokenizer("text"))


def _context(gram: str = "gram") -> Column:
    return F.substring(gram, F.lit(1), F.length(gram) - 1)


def _suffix(gram: str = "gram") -> Column:
    return F.substring(gram, F.lit(2), F.length(gram))


def sentence(text: Column | str) -> Column:
    """The character tokens of a text between sentence marks, packed."""
    return F.concat(F.lit(_BEGIN), squeeze(text), F.lit(_END))


def label_sentences(corpus: DataFrame, order: int = NGRAM_ORDER) -> DataFrame:
    """(lid_label, own, ahead): the documents of a label as one sentence, in document order.

    ``own`` is a document's part of the sentence and ``ahead`` the ``order`` - 1 characters
    that follow it, so that n-grams run over the ends of documents and no label
    is gathered in one value.
    """
    parts = corpus.select("lid_label", "doc_id", squeeze("text").alias("own")).filter(F.length("own") > 0)
    placed = stored(position(parts, ["lid_label"], "doc_id", "pos"), "sentences")
    # Null labels are a label too.
    ends = placed.groupBy(F.col("lid_label").alias("ended")).agg(F.max("pos").alias("last"))
    marked = placed.join(ends, F.col("lid_label").eqNullSafe(F.col("ended"))).drop("ended").withColumn(
        "own",
        F.concat(
            F.when(F.col("pos") == 1, F.lit(_BEGIN)).otherwise(""),
            "own",
            F.when(F.col("pos") == F.col("last"), F.lit(_END)).otherwise(""),
        ),
    )
    # Each document lends its start to as many before it as can reach it.
    lent = marked.select(
        "lid_label",
        F.explode(F.sequence(F.lit(1), F.lit(max(order - 1, 1)))).alias("step"),
        "pos",
        F.substring("own", 1, order).alias("start"),
    ).select("lid_label", (F.col("pos") - F.col("step")).alias("pos"), F.struct("step", "start").alias("next"))
    ahead = lent.groupBy(F.col("lid_label").alias("lent_to"), F.col("pos").alias("lent_at")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("next")), lambda x: x["start"]), "").alias("ahead")
    )
    found = marked.join(ahead, F.col("lid_label").eqNullSafe(F.col("lent_to")) & (F.col("pos") == F.col("lent_at")), "left")
    return found.select("lid_label", "own", F.substring(F.coalesce("ahead", F.lit("")), 1, order - 1).alias("ahead"))


def ngram_counts(corpus: DataFrame, order: int = NGRAM_ORDER, sentence_is: str = "document") -> DataFrame:
    """(lid_label, n, gram, cnt) for n up to ``order``, sentence marks included.

    A sentence is a document, or with ``sentence_is='label'`` all of a label. Only the
    longest run at each place is counted; shorter n-grams are the
    starts of longer ones and are summed from those counts, so the text is walked
    once and not once per order.
    """
    if sentence_is == "label":
        parts = label_sentences(corpus, order)
        runs = count_runs(parts, "lid_label", F.concat("own", "ahead"), order, F.length("own"))
    else:
        said = corpus.select("lid_label", sentence("text").alias("said"))
        runs = count_runs(said, "lid_label", F.col("said"), order, F.octet_length("said"))
    runs = runs.select("lid_label", F.col("gram").alias("run"), F.col("cnt").alias("c"))
    starts = F.transform(F.sequence(F.lit(1), F.length("run")), lambda n: F.substring(F.col("run"), F.lit(1), n))
    return (
        runs.select("lid_label", "c", F.explode(starts).alias("gram"))
        .groupBy("lid_label", "gram")
        .agg(F.sum("c").alias("cnt"))
        .select("lid_label", F.length("gram").alias("n"), "gram", "cnt")
    )


def adjusted_counts(counts: DataFrame, order: int = NGRAM_ORDER) -> DataFrame:
    """Highest order as counted, lower ones by distinct left neighbours; starts of a sentence stay as counted."""
    starts = F.startswith("gram", F.lit(_BEGIN))
    kept = counts.filter((F.col("n") == order) | starts).select("lid_label", "n", "gram", F.col("cnt").alias("adj"))
    lower = (
        counts.filter(F.col("n") > 1)
        .select("lid_label", _suffix().alias("gram"))
        .groupBy("lid_label", "gram")
        .agg(F.count(F.lit(1)).alias("adj"))
        .select("lid_label", F.length("gram").alias("n"), "gram", "adj")
    )
    return kept.unionByName(lower)


def _predicted(adjusted: DataFrame) -> DataFrame:
    """Without the begin mark as a unigram: it is never predicted."""
    return adjusted.filter(F.col("gram") != _BEGIN)


def discounts(adjusted: DataFrame) -> DataFrame:
    """(lid_label, n, d1, d2, d3) from counts of counts; 0.5, 1, 1.5 where they are undefined."""
    t = {k: F.count_if(F.col("adj") == k).cast("double") for k in (1, 2, 3, 4)}
    tallies = _predicted(adjusted).groupBy("lid_label", "n").agg(*[c.alias(f"t{k}") for k, c in t.items()])
    y = F.try_divide("t1", F.col("t1") + 2 * F.col("t2"))
    raw = {k: k - F.try_divide((k + 1) * y * F.col(f"t{k + 1}"), F.col(f"t{k}")) for k in (1, 2, 3)}
    sound = F.lit(True)
    for k, d in raw.items():
        sound = sound & (F.col(f"t{k}") > 0) & (d >= 0) & (d <= k)
    sound = F.coalesce(sound, F.lit(False))
    return tallies.select(
        "lid_label",
        "n",
        *[F.when(sound, raw[k]).otherwise(F.lit(v)).alias(f"d{k}") for k, v in ((1, 0.5), (2, 1.0), (3, 1.5))],
    )


def kn_model(counts: DataFrame, order: int = NGRAM_ORDER) -> DataFrame:
    """(lid_label, n, gram, log10_prob, log10_backoff) for every n-gram of the corpus and ``<unk>``.

    ``counts`` should be stored or materialised, as each order reads it.
    """
    adjusted = adjusted_counts(counts, order)
    rates = discounts(adjusted)
    cut = F.when(F.col("adj") == 1, F.col("d1")).when(F.col("adj") == 2, F.col("d2")).otherwise(F.col("d3"))
    scored = (
        _predicted(adjusted)
        .join(rates, ["lid_label", "n"])
        .select("lid_label", "n", "gram", "adj", cut.alias("discount"), _context().alias("context"))
    )
    # Mass that discounting frees in a context; the context of a unigram is empty.
    contexts = scored.groupBy("lid_label", "context").agg(
        F.sum("adj").alias("total"), (F.sum("discount") / F.sum("adj")).alias("gamma")
    )
    direct = stored(
        scored.join(contexts, ["lid_label", "context"]).select(
            "lid_label", "n", "gram", "context", ((F.col("adj") - F.col("discount")) / F.col("total")).alias("own"), "gamma"
        ),
        "own-probabilities",
        # Each order reads its own n-grams only.
        partition_by=("n",),
    )
    first = direct.filter(F.col("n") == 1)
    sizes = first.groupBy("lid_label").agg((F.count(F.lit(1)) + 1).alias("v"), F.max("gamma").alias("free"))
    level = (
        first.join(sizes, "lid_label")
        .select("lid_label", "gram", (F.col("own") + F.col("free") / F.col("v")).alias("prob"))
        .unionByName(sizes.select("lid_label", F.lit(_UNKNOWN).alias("gram"), (F.col("free") / F.col("v")).alias("prob")))
    )
    levels = [level]
    for n in range(2, order + 1):
        shorter = level.select("lid_label", F.col("gram").alias("suffix"), F.col("prob").alias("below"))
        level = (
            direct.filter(F.col("n") == n)
            .withColumn("suffix", _suffix())
            .join(shorter, ["lid_label", "suffix"])
            .select("lid_label", "gram", (F.col("own") + F.col("gamma") * F.col("below")).alias("prob"))
        )
        # The next order and the result both read a level.
        level = stored(level, "level") if n < order else level
        levels.append(level)
    # The begin mark has no probability but leads contexts.
    marks = sizes.select("lid_label", F.lit(_BEGIN).alias("gram"), F.lit(None).cast("double").alias("prob"))
    backoffs = (
        direct.filter(F.col("n") > 1).groupBy("lid_label", F.col("context").alias("gram")).agg(F.max("gamma").alias("gamma"))
    )
    return (
        reduce(DataFrame.unionByName, [*levels, marks])
        .join(backoffs, ["lid_label", "gram"], "left")
        .select(
            "lid_label",
            F.length("gram").alias("n"),
            "gram",
            F.log10("prob").alias("log10_prob"),
            F.coalesce(F.log10("gamma"), F.lit(0.0)).alias("log10_backoff"),
        )
    )


def score_documents(documents: DataFrame, model: DataFrame, order: int = NGRAM_ORDER) -> DataFrame:
    """(doc_id, lid_label, n_tokens, log10_prob, perplexity) of documents under their label's model.

    A window is a token with its history. Windows move once: they are dealt out by the last two characters of the
    history and sorted by the history read backwards, together with the model's n-grams. A context then comes right before
    all histories that end in it, so one pass holds the contexts of the history at hand and no others, and backs off
    through them. Documents without a label, or whose label has no model, are left out.
    """
    sent = sentence("text")
    # Windows of full length, and the starts of the sentence where the history is shorter.
    sized = [F.when(F.length(sent) >= k, F.substring(sent, F.lit(1), F.lit(k))) for k in range(2, order)]
    starts = F.array_compact(F.array(*sized)) if sized else F.array().cast("array<string>")
    asked = (
        documents.filter(F.col("lid_label").isNotNull())
        .select("lid_label", "doc_id", F.explode(F.concat(starts, char_ngrams(sent, order))).alias("gram"))
        .select("lid_label", "doc_id", F.reverse(_context()).alias("past"), _token().alias("token"))
    )
    blocks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.hash("lid_label", F.substring("past", 1, 2)), F.lit(blocks)).alias("block")
    grams = model.filter(F.col("lid_label").isNotNull())
    followers = grams.filter(F.col("log10_prob").isNotNull()).select(
        "lid_label", F.reverse(_context()).alias("past"), F.lit(_FOLLOWER).alias("kind"), _token().alias("token"), F.col("log10_prob").alias("value")
    )
    contexts = grams.filter(F.col("n") < order).select(
        "lid_label", F.reverse("gram").alias("past"), F.lit(_CONTEXT).alias("kind"), F.lit("").alias("token"), F.col("log10_backoff").alias("value")
    )
    table = contexts.unionByName(followers)
    longer = table.filter(F.length("past") >= 2).select(block, "*")
    # Unigrams and bigrams belong to many blocks; each gets those of the histories it has.
    met = asked.select("lid_label", block, F.substring("past", 1, 1).alias("last")).distinct()
    wanted = met.select("lid_label", "block", F.explode(F.array("last", F.lit(""))).alias("past")).distinct()
    shorter = table.filter(F.length("past") < 2).join(wanted, ["lid_label", "past"]).select(longer.columns)
    no_doc = F.lit(None).cast(documents.schema["doc_id"].dataType).alias("doc_id")
    rows = longer.unionByName(shorter).select("*", no_doc).unionByName(
        asked.select(block, "*", F.lit(_ASKED).alias("kind"), F.lit(None).cast("double").alias("value"))
    )
    met_in_order = rows.repartition(blocks, "block").sortWithinPartitions("block", "lid_label", "past", "kind", "token")
    return (
        met_in_order.mapInArrow(_back_off, rows.select("lid_label", "doc_id", F.col("value").alias("logp")).schema)
        .groupBy("doc_id", "lid_label")
        .agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("logp").alias("log10_prob"))
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")))
    )


# What a row is, in the order in which a pass needs them.
_CONTEXT, _FOLLOWER, _ASKED = 0, 1, 2


def _token(gram: str = "gram") -> Column:
    return F.substring(gram, -1, 1)


def _back_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lid_label, doc_id, logp) of the windows in a sorted stream of n-grams and windows.

    ``path`` holds the known contexts that begin the history at hand, shortest first: the history itself backwards, what it pays
    to go on with less, and the tokens known after it.
    """
    group, path = None, []
    for batch in batches:
        keys = ["block", "lid_label", "past", "kind", "token"]
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[:1] = True
        for key in keys:
            column = batch.column(key)
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        # Equal windows are one run and are scored once.
        runs = np.flatnonzero(changed)
        heads = batch.select([*keys, "value"]).take(pa.array(runs))
        scores = np.full(len(runs), np.nan)
        for i, (block, label, past, kind, token, value) in enumerate(zip(*(c.to_pylist() for c in heads.columns))):
            if (block, label) != group:
                group, path = (block, label), []
            while path and not past.startswith(path[-1][0]):
                path.pop()
            if kind == _ASKED:
                scores[i] = _log_prob(path, token)
                continue
            if not path or path[-1][0] != past:
                path.append([past, 0.0, {}])
            if kind == _CONTEXT:
                path[-1][1] = value
            else:
                path[-1][2][token] = value
        logp = np.repeat(scores, np.diff(np.append(runs, batch.num_rows)))
        # Only windows have a score, and those of labels without a model have none.
        scored = pa.array(~np.isnan(logp))
        found = batch.select(["lid_label", "doc_id"]).append_column("logp", pa.array(logp))
        yield found.filter(scored)


def _log_prob(path: list, token: str) -> float:
    paid = 0.0
    for _, backoff, followers in reversed(path):
        if token in followers:
            return followers[token] + paid
        paid += backoff
    # Unigrams are the followers of the empty context, which pays nothing.
    unknown = path[0][2].get(_UNKNOWN) if path else None
    return float("nan") if unknown is None else unknown + paid


def arpa_lines(model: DataFrame, order: int = NGRAM_ORDER) -> DataFrame:
    """(lid_label, section, line): the model as ARPA text, to be written sorted by section and line."""
    # A chance next to one is written without the sign that its logarithm loses to the rounding.
    number = lambda c: F.regexp_replace(F.format_string("%.7f", c), "^-(?=0\\.0+$)", "")
    entry = F.concat_ws(
        "\t",
        F.when(F.col("log10_prob").isNull(), F.lit("-99")).otherwise(number("log10_prob")),
        shown("gram"),
        F.when((F.col("n") < order) & ~F.endswith("gram", F.lit(_END)), number("log10_backoff")),
    )
    grams = model.select("lid_label", F.col("n").alias("section"), F.lit(1).alias("part"), entry.alias("line"))
    sizes = model.groupBy("lid_label", "n").agg(F.count(F.lit(1)).alias("c"))
    count_lines = sizes.select(
        "lid_label", F.lit(0).alias("section"), F.lit(1).alias("part"), F.concat(F.lit("ngram "), "n", F.lit("="), "c").alias("line")
    )
    heads = sizes.select("lid_label", F.col("n").alias("section"), F.lit(0).alias("part"), F.concat(F.lit("\\"), "n", F.lit("-grams:")).alias("line"))
    tails = sizes.select("lid_label", F.col("n").alias("section"), F.lit(2).alias("part"), F.lit("").alias("line"))
    labels = model.select("lid_label").distinct()
    frame = [(0, 0, "\\data\\"), (0, 2, ""), (order + 1, 0, "\\end\\")]
    out = grams.unionByName(count_lines).unionByName(heads).unionByName(tails)
    for section, part, line in frame:
        out = out.unionByName(labels.select("lid_label", F.lit(section).alias("section"), F.lit(part).alias("part"), F.lit(line).alias("line")))
    return out
