"""Line deduplication as an exact set-similarity join, in DataFrame operations only.

A line is the set of its tokens (separated by white space). Two lines match if the Jaccard similarity of their
sets is at least 0.8. A line goes if any earlier line matches it, whether or not that one goes too; earlier
means a smaller document id, or the same document and a smaller line number. Of rows with the same id (or none) and
different texts, one stands before the other by text hash. Lines without tokens stay.

Equal lines are first reduced to their earliest one. Tokens are ordered from rare to common by the
levels of a hashed count table of fixed size; ties are ordered by hash, so the order is total. Lines that match share a token among their
first ``n - ceil(0.8 n) + 1`` ones (prefix filter); lengths, the positions of the shared token and 128 parity bits of
both sets bound the overlap from above (length, positional and bitmap filter), and so does the number of tokens that the
prefixes of a pair share. What passes is verified on the tokens themselves.

Of two matching lines the shorter one (or equally long) has the shared token even among its first
``n - ceil(8/9 n) + 1``. These near postings are joined with each other and with the far ones of longer lines, so two far ones
never meet. In a list with more than ``LONG`` near postings a line first meets the first line of the list alone; only lines that are
still without a match then meet the rest of it. So a group of thousands of variants costs a few comparisons for each
line, and no match is lost.

What is stored on the way goes as soon as the next step has read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.llm.common import staged, unstaged

BUCKETS = 1 << 18
STEPS = (1, 4, 16, 64, 256)  # a bucket with so many times the mean count holds common tokens
RARE = 200  # tokens seen less often are not told apart: their lists are short anyway
LONG = 512
NO_ID = -(1 << 63)  # a NULL id stands before all others
NUMBER_BITS = VERSION_BITS = 31  # a text holds less than 2 GB
SPACES = "\t\n\x0b\f\r"
WORDS = 1 << 17  # of 64 bits each, in a bitmap of fixed size
LINE = ["doc", "at", "h1"]
SIGS = [f"sig{k}" for k in range(2)]
# Jaccard 4/5 means an overlap of at least 4/9 (n + m) and at most 1/9 (n + m) tokens that differ
MATCH = (
    f"9 * ({' + '.join(f'bit_count({s} ^ other_{s})' for s in SIGS)}) <= n + other_n"
    " and 9 * least(n - i, other_n - other_i) >= 4 * (n + other_n)"
    " and 5 * least(n, other_n) >= 4 * greatest(n, other_n)"
)
NEAR = "i < n - (8 * n + 8) div 9 + 1"
# the shorter line has the first shared token among its near ones, so a far posting meets near ones of shorter lines only
MEETS = "case when near and other_near then id <> other_id when near then other_n > n else other_near and n > other_n end"
# prefixes of n - t + l and m - t + l tokens share at least l where the lines share t = ceil(4/9 (n + m))
SHARED = (
    "size(array_intersect(prefix, other_prefix)) + size(prefix) - size(array_distinct(prefix))"
    " >= (4 * (n + other_n) + 8) div 9 + least(size(prefix) - n, size(other_prefix) - other_n)"
)
# a pair is taken at the first token that its prefixes share, in the order of the shorter line
FIRST = (
    "token = case when struct(n, id) < struct(other_n, other_id)"
    " then get(array_intersect(prefix, other_prefix), 0) else get(array_intersect(other_prefix, prefix), 0) end"
)
LATER = "({a}doc > {b}doc or ({a}doc = {b}doc and ({a}at > {b}at or ({a}at = {b}at and {a}h1 > {b}h1))))"


def _version(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(text_col))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, version, text``; the version tells apart rows that share an id but not the text."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        _version(id_col, text_col).alias("version"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, version, at, line`` of the lines that hold a token.

    ``at`` orders the lines of an id: the upper bits of the version, then the line number. Only with the version, or with the
    line itself (its hash ``h1``), is it the place of one line.
    """
    return (
        _rows(docs, id_col, text_col)
        .select("doc", "version", F.posexplode(F.split("text", "\n")).alias("number", "line"))
        .filter(F.col("line").rlike(r"\S"))
        .select("doc", "version", (F.shiftleft(F.shiftrightunsigned("version", 64 - VERSION_BITS), NUMBER_BITS) + F.col("number")).alias("at"), "line")
    )


def _tokens(line: Column) -> Column:
    return F.array_remove(_split(line), "")


def _split(text: Column) -> Column:
    """As ``split(text, "\\\\s+")``, with empty strings beside longer white space; one blank splits much faster than a pattern."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.split(text, " ")


def _first_places(lines: DataFrame, *keys: str, also: tuple[str, ...] = ()) -> DataFrame:
    """The earliest place of each group of equal lines, by a fixed-size minimum that combines before the shuffle."""
    place = F.col("doc").cast("decimal(19,0)") * F.lit(1 << (VERSION_BITS + NUMBER_BITS)).cast("decimal(19,0)") + F.col("at")
    return (
        lines.withColumn("place", place)
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"), F.min_by("doc", "place").alias("first_doc"), F.min_by("at", "place").alias("first_at"), *(F.min_by(c, "place").alias(f"first_{c}") for c in also))
    )


def _same_line() -> list[Column]:
    """128 bits that tell lines apart."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]


def _levels(docs: DataFrame, text_col: str) -> bytes:
    """One byte for each bucket of tokens: how many of ``STEPS`` times the mean count it reaches.

    The table has ``BUCKETS`` bytes, whatever the size of the corpus.
    """
    counts = staged(
        docs.select(F.explode(_split(F.coalesce(F.col(text_col), F.lit("")))).alias("token"))
        .filter("token <> ''")
        .select(_bucket(F.xxhash64("token")).alias("bucket"))
        .groupBy("bucket")
        .count()
    )
    mean = (counts.agg(F.sum("count")).first()[0] or 0) / BUCKETS
    unit = max(mean, RARE / STEPS[0])
    level = sum((F.col("count") >= factor * unit).cast("int") for factor in STEPS)
    marked = counts.filter(level > 0).select((F.col("bucket") * 8 + level).alias("entry"))
    table = bytearray(BUCKETS)
    for entry in marked.agg(F.collect_list("entry")).first()[0]:  # at most BUCKETS whole numbers
        table[entry >> 3] = entry & 7
    unstaged(counts)
    return bytes(table)


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, doc, at, version, h1, h2, copies, n, sig0, sig1, prefix`` of each distinct line, at its earliest place; stored once.

    The table of levels stands in the plan of this job alone: in those of the joins, the texts of the plans fill the driver.
    """
    table = F.lit(_levels(docs, text_col))

    def rank(h: Column) -> Column:
        level = F.ascii(F.substring(table, _bucket(h) + 1, F.lit(1)).cast("string")).cast("long")
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    # common tokens last, then by hash: a total order of the tokens
    ranks = F.transform("hashes", rank)
    sig = "aggregate(filter(ranks, r -> (r & 64) = {part}), 0L, (acc, r) -> acc ^ shiftleft(1L, cast(r & 63 as int)))"
    sets = (
        _lines(docs, id_col, text_col)
        .withColumn("hashes", F.array_distinct(F.transform(_tokens(F.col("line")), lambda t: F.xxhash64(t))))
        .withColumn("ranks", F.sort_array(ranks))
        .select(
            "doc",
            "at",
            "version",
            *_same_line(),
            F.size("ranks").cast("long").alias("n"),
            *(F.expr(sig.format(part=64 * k)).alias(s) for k, s in enumerate(SIGS)),
            F.expr(
                "transform(slice(ranks, 1, size(ranks) - (4 * size(ranks) + 4) div 5 + 1), r -> cast(r & 2147483647 as int))"
            ).alias("prefix"),
        )
    )
    keys = ("h1", "h2", "n", *SIGS, "prefix")
    classes = _first_places(sets, *keys, also=("version",))
    places = (F.col(f"first_{c}").alias(c) for c in ("doc", "at", "version"))
    return staged(classes.select(F.monotonically_increasing_id().alias("id"), *places, "copies", *keys))


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct ones of ``pairs (id, other_id)`` whose prefixes share as many tokens as those of matching lines do.

    The later line comes back as ``id, doc, at, h1``, the earlier one as ``other_id, other_doc, other_at, other_h1``. Two
    tokens of a prefix with the same 31 bits count twice.
    """
    lines = classes.select("id", *LINE, "n", "prefix")
    others = lines.select(*(F.col(c).alias(f"other_{c}") for c in lines.columns))
    return _ordered(pairs.distinct().join(lines, "id").join(others, "other_id").filter(SHARED))


def _bit(h: Column) -> tuple[Column, Column]:
    """The word of a hash in a bitmap of ``WORDS`` words, and its bit there."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    return F.shiftright(h, 6).bitwiseAND(F.lit(WORDS - 1).cast("long")), bit


def _only(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Those of ``rows`` whose ``keys`` may be among ``wanted``: a bitmap of fixed size (1 MB) spares the others the shuffle
    that follows. It lets too many through, never too few."""
    word, bit = _bit(F.xxhash64(*keys))
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return rows.join(F.broadcast(words), (F.col("word") == word) & (F.col("bits").bitwiseAND(bit) != 0), "left_semi")


def _postings(classes: DataFrame) -> DataFrame:
    """``id, doc, n, sig0, sig1, i, token, near`` for each token of the prefixes."""
    postings = classes.select("id", "doc", F.col("n").cast("int").alias("n"), *SIGS, F.posexplode("prefix").alias("i", "token"))
    return postings.withColumn("near", F.expr(NEAR))


def _verified(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` of the later lines of the pairs whose token sets have Jaccard 0.8 or more."""
    ends = [pairs.select(*(F.col(f"{side}{c}").alias(c) for c in ("id", *LINE))) for side in ("", "other_")]
    wanted = staged(ends[0].union(ends[1]).distinct())
    lines = _lines(docs, id_col, text_col).select("doc", "at", *_same_line()[:1], "line")
    lines = staged(_only(lines, wanted, LINE).join(wanted, LINE).groupBy("id").agg(F.first("line").alias("line")))
    unstaged(wanted)
    counted = lines.withColumn("n", F.size(F.array_distinct(_tokens(F.col("line")))))
    others = counted.select(*(F.col(c).alias(f"other_{c}") for c in counted.columns))
    both = pairs.select("id", "other_id").join(counted, "id").join(others, "other_id")
    # the intersection holds each token once; it stands in the test once, so each pair is cut and compared once
    common = F.size(F.array_intersect(_tokens(F.col("line")), _tokens(F.col("other_line"))))
    found = staged(both.filter(9 * common >= 4 * (F.col("n") + F.col("other_n"))).select("id").distinct())
    unstaged(lines)
    return found


def _matched(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` of the distinct lines that match an earlier line which is not equal."""
    of_token = Window.partitionBy("token")
    lists = (
        _postings(classes)
        .withColumn("size", F.count_if("near").over(of_token))
        .withColumn("first", F.min_by(F.when(F.col("near"), F.col("id")), F.when(F.col("near"), F.col("doc"))).over(of_token))
    )
    sides = ("id", "n", "i", "near", *SIGS)
    other = lists.filter("near").select("token", *(F.col(c).alias(f"other_{c}") for c in sides))
    passes, meets = F.expr(MATCH), F.expr(MEETS)
    long, first = F.col("size") > LONG, F.col("other_id") == F.col("first")
    # of two near postings the one with the smaller id asks; in a long list all ask its first one, whatever the lengths
    asks = ~long & meets & passes & (~F.col("near") | (F.col("id") < F.col("other_id")))
    met = lists.join(other, "token").filter(asks | (long & first))
    of_long = (F.when(long, F.col(c)).alias(c) for c in ("token", "i"))
    met = staged(met.select("id", "other_id", long.alias("long"), (~long | (passes & (F.col("id") != F.col("other_id")))).alias("passes"), *of_long))
    candidates = staged(_plausible(met.filter("passes").select("id", "other_id"), classes))
    # one candidate of each line is tried first; nearly all that pass the filters match
    others = [f"other_{c}" for c in ("id", *LINE)]
    tried = staged(candidates.groupBy("id", *LINE).agg(*(F.min_by(c, "other_h1").alias(c) for c in others)))
    found = _verified(docs, tried, id_col, text_col)
    unstaged(tried)
    # lines of a group share many tokens: with the prefixes at hand, a pair leaves the join of the open lines once, and only if it is plausible
    sides = ("id", "doc", "n", "prefix", *SIGS)
    postings = staged(met.filter("long").select("id", "token", "i").join(classes.select(*sides), "id").withColumn("near", F.expr(NEAR)))
    unstaged(met)
    others = postings.select("token", *(F.col(c).alias(f"other_{c}") for c in ("i", "near", *sides)))
    rest = postings.join(found, "id", "left_anti").join(others, "token")
    rest = rest.filter((F.col("doc") >= F.col("other_doc")) & meets & passes & F.expr(FIRST) & F.expr(SHARED))
    rest = staged(rest.select("id", "other_id"))
    unstaged(postings)
    open_pairs = candidates.join(found, "id", "left_anti")
    pairs = staged(open_pairs.union(_plausible(rest, classes).select(open_pairs.columns)).distinct())
    unstaged(rest, candidates)
    late = _verified(docs, pairs, id_col, text_col)
    matched = staged(found.union(late).distinct())
    unstaged(pairs, found, late)
    return matched


def _ordered(pairs: DataFrame) -> DataFrame:
    """The later line of each pair as ``id, doc, at, h1``, the earlier one as ``other_id, other_doc, other_at, other_h1``."""
    earlier = F.expr(LATER.format(a="other_", b=""))
    names = [(c, f"other_{c}") for c in ("id", *LINE)]
    return pairs.select(
        *(F.when(earlier, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in names),
        *(F.when(earlier, F.col(a)).otherwise(F.col(b)).alias(b) for a, b in names),
    )


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, version, numbers``: the sorted numbers (from 0) of the lines that go, for documents that lose any. Stored."""
    classes = _classes(docs, id_col, text_col)
    matched = _matched(docs, classes, id_col, text_col)
    # a line that is the only one of its class stays unless it is matched
    places = (F.col(c).alias(f"first_{c}") for c in ("doc", "at", "version"))
    losing = staged(classes.join(matched.withColumn("matched", F.lit(True)), "id", "left").filter("matched or copies > 1").select("h1", "h2", "matched", *places))
    unstaged(classes, matched)
    lines = _lines(docs, id_col, text_col).select("doc", "version", "at", *_same_line())
    gone = _only(lines, losing, ["h1", "h2"]).join(losing, ["h1", "h2"]).filter(
        F.col("matched") | F.expr("doc <> first_doc or at <> first_at or version <> first_version")
    )
    number = F.col("at").bitwiseAND((1 << NUMBER_BITS) - 1).cast("int")
    numbers = staged(gone.groupBy("doc", "version").agg(F.sort_array(F.collect_set(number)).alias("numbers")))
    unstaged(losing)
    return numbers


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``__lines`` (how many there are) and ``__gone`` (numbers of those to remove).

    Texts that are NULL or empty have one empty line, which stays. Fully repeated rows are the same document and
    lose the same lines. An empty table gives an empty result.
    """
    gone = removed_lines(docs, id_col, text_col).select(
        F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("numbers").alias("__numbers")
    )
    return (
        docs.withColumn("__lines", F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).cast("long"))
        .withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
        .withColumn("__hash", _version(id_col, text_col))
        .join(gone, (F.col("__id") == F.col("__doc")) & (F.col("__hash") == F.col("__version")), "left")
        .withColumn("__gone", F.coalesce("__numbers", F.expr("cast(array() as array<int>)")))
        .drop("__doc", "__version", "__numbers", "__id", "__hash")
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines of each text, joined by line breaks; texts that lose nothing stay as they are."""
    # the runs between removed lines; the outer transform holds the lines, split once
    gaps = "zip_with(concat(array(-1), __gone), concat(__gone, array(size(ls))), (a, b) -> struct(a + 2 as k, b - a - 1 as m))"
    kept = F.array_join(
        F.expr(f"transform(array(split(`{text_col}`, '\n')), ls -> flatten(transform({gaps}, g -> slice(ls, g.k, g.m))))")[0], "\n"
    )
    return (
        dedup_lines(docs, id_col, text_col)
        .withColumn(text_col, F.when(F.size("__gone") > 0, kept).otherwise(F.col(text_col)))
        .select(*docs.columns)
    )
