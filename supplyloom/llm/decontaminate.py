"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds a posting (term, document, position) for every occurrence, in the training texts, of a word that
the test items use. A test phrase is looked up from its rarest terms: the postings of the rarest one, moved by
its offset, are the possible starts; the list of the second rarest one, moved by its own offset, is intersected
with them; what is left is compared word by word with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.llm.common import lower_ascii, staged

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words(text: Column) -> Column:
    """Words of letters, digits and everything beyond ASCII, A-Z in lower case; NULL has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``term, doc, version, pos`` of the given distinct ``terms (term)``, stored in the shared folder.

    ``version`` is a hash of the text, so rows that share an id keep their own postings.
    """
    tokens = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("version"),
        F.posexplode(words(F.col(text_col))).alias("pos", "term"),
    )
    return staged(tokens.join(terms, "term").select("term", "doc", "version", "pos"))


def item_windows(items: DataFrame, size: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, phrase``: each run of ``size`` consecutive words; the whole item if it is shorter, none if empty."""
    split = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
    return (
        split.filter(F.size("w") > 0)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))))
        .select("item", F.array_join(F.slice("w", F.col("at"), size), " ").alias("phrase"))
        .distinct()
    )


def phrase_starts(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc, version, phrase, start``: places where the two rarest terms of a phrase stand at their offsets.

    A phrase with a word that has no posting cannot occur and drops out before any list is read.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("freq"))
    placed = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    by_phrase = Window.partitionBy("phrase")
    ranked = (
        placed.join(counts, "term", "left")
        .withColumn("present", F.min(F.coalesce("freq", F.lit(0))).over(by_phrase))
        .filter("present > 0")
        .withColumn("rank", F.row_number().over(by_phrase.orderBy("freq", "offset")))
        .filter("rank <= 2")
    )
    keys = staged(
        ranked.groupBy("phrase").agg(
            *(F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}{r}") for r in (1, 2) for c in ("term", "offset"))
        )
    )
    starts = index.join(keys, F.col("term") == F.col("term1")).select(
        "doc", "version", "phrase", "term2", "offset2", (F.col("pos") - F.col("offset1")).alias("start")
    )
    starts = starts.filter("start >= 0")
    second = index.join(keys.select(F.col("term2").alias("term")).distinct(), "term", "left_semi").select(
        F.col("term").alias("t"), F.col("doc").alias("d"), F.col("version").alias("v"), F.col("pos").alias("p")
    )
    joined = starts.filter("term2 is not null").join(
        second,
        (F.col("term2") == F.col("t"))
        & F.col("doc").eqNullSafe(F.col("d"))
        & (F.col("version") == F.col("v"))
        & (F.col("start") + F.col("offset2") == F.col("p")),
        "left_semi",
    )
    out = ["doc", "version", "phrase", "start"]
    return joined.select(out).union(starts.filter("term2 is null").select(out))


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """``doc, version, first, second, pos, other``: pairs of terms (``first, second``) at most ``within`` words apart.

    The lists are joined on document and block of ``within`` positions (own, previous and next block), so a
    long list of one document is never paired with itself as a whole.
    """
    left = index.join(pairs, index.term == pairs["first"]).select(
        "doc", "version", "first", "second", "pos", F.explode(F.array(*(F.floor(F.col("pos") / within) + i for i in (-1, 0, 1)))).alias("block")
    )
    right = index.select(
        F.col("term").alias("t"), F.col("doc").alias("d"), F.col("version").alias("v"), F.col("pos").alias("other"), F.floor(F.col("pos") / within).alias("b")
    )
    close = (F.abs(F.col("pos") - F.col("other")) <= within) & ((F.col("first") != F.col("second")) | (F.col("pos") != F.col("other")))
    return left.join(
        right,
        (F.col("second") == F.col("t")) & F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")) & (F.col("block") == F.col("b")) & close,
    ).select("doc", "version", "first", "second", "pos", "other")


def find_items(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``doc, version, spans, items`` for every text that contains a window of an item.

    ``spans`` holds (start, length) in words of each occurrence, ``items`` the distinct item ids as sorted strings
    (a NULL id counts as the empty string). Repeated rows of an id with equal texts are one entry. Texts and
    items without words never match.
    """
    windows = staged(item_windows(items, size, item_col, item_text_col))
    phrases = windows.select("phrase").distinct()
    terms = phrases.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    index = build_index(docs, terms, id_col, text_col)
    starts = phrase_starts(index, phrases)
    per_doc = starts.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "phrase")).alias("maybe"))
    texts = docs.select(
        F.col(id_col).alias("d"), F.xxhash64(F.col(text_col)).alias("v"), F.col(text_col).alias("t")
    )
    checked = (
        per_doc.join(texts, F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")))
        .withColumn("w", words(F.col("t")))
        .select(
            "doc",
            "version",
            F.expr("filter(maybe, m -> slice(w, m.start + 1, size(split(m.phrase, ' '))) = split(m.phrase, ' '))").alias("found"),
        )
        .filter(F.size("found") > 0)
        .dropDuplicates(["doc", "version"])
    )
    checked = staged(checked)
    named = (
        checked.select("doc", "version", F.explode("found.phrase").alias("phrase"))
        .distinct()
        .join(windows, "phrase")
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(F.col("doc").alias("d"), F.col("version").alias("v"), "items")
    )
    spans = F.expr("transform(found, m -> struct(m.start as start, size(split(m.phrase, ' ')) as length))")
    return checked.join(named, F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))).select(
        "doc", "version", spans.alias("spans"), "items"
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word inside several occurrences counts once. Rows without words, and all rows if there are no items, have
    no hits and the digest of the empty string.
    """
    found = find_items(docs, items, size, id_col, text_col).select(
        "doc",
        "version",
        F.size(F.array_distinct(F.expr("flatten(transform(spans, s -> sequence(s.start, s.start + s.length - 1)))"))).cast("long").alias("hits"),
        "items",
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("v"),
        F.size(words(F.col(text_col))).cast("long").alias("n_words"),
    )
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("v") == F.col("version")), "left")
    hits = F.coalesce("hits", F.lit(0).cast("long"))
    names = F.coalesce(F.array_join("items", ","), F.lit(""))
    return joined.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item, with all their columns, whatever they are called."""
    found = find_items(docs, items, size, id_col, text_col).select(F.col("doc").alias("__hit_doc"), F.col("version").alias("__hit_version"))
    same = F.col(id_col).eqNullSafe(F.col("__hit_doc")) & (F.xxhash64(F.col(text_col)) == F.col("__hit_version"))
    return docs.join(found, same, "left_anti")
