"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import whole_text
from demandspark.session import staged

#: The contract's words, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window.
WINDOW = 10
#: A table goes to all executors up to this many bytes of text, or rows of fixed width; else the join is salted.
SENT_BYTES, SENT_ROWS = 16_000_000, 500_000
#: Keys that a hot term is divided into where a table is too large to be sent.
SALTS = 32
#: Stands for the end of a document in the index; never a word, as words hold no spaces.
END = " "
END_TERM = -1


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.translate(whole_text(text), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def join_sent(rows: DataFrame, small: DataFrame, key: str, fits: bool) -> DataFrame:
    """Join a large table that may have hot keys with one that is sent whole if it ``fits``, else repeated once a salt."""
    if fits:
        return rows.join(F.broadcast(small), key)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
            .join(salted, [key, "_salt"]).drop("_salt"))


def vocabulary(items: DataFrame, text: str = "text") -> DataFrame:
    """``word, term``: a number for each distinct word of the items and one for the end of a document."""
    found = items.select(F.explode(words(text)).alias("word")).distinct()
    numbered = found.select("word", F.monotonically_increasing_id().alias("term"))
    end = items.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(END_TERM).cast("long").alias("term"))
    return staged(numbered.unionByName(end))


def build_index(docs: DataFrame, vocab: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Positional postings ``term, row, pos, doc_id`` of the vocabulary's words, stored in the shared folder.

    Every partition of documents is a shard, sorted by term, then document and position: the lists of
    a term lie together, and a scan for a few terms skips the rest. Nothing is shuffled if the vocabulary
    can be sent. A document has one posting of ``END_TERM`` at its number of words, which carries its id.
    """
    fits = vocab.agg(F.sum(F.octet_length("word") + 40)).first()[0] <= SENT_BYTES
    # The number comes first: beside a generator it would count words.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"),
                       F.concat(words(text), F.array(F.lit(END))).alias("words"))
    tokens = rows.select("row", "id", F.posexplode("words").alias("pos", "word"))
    tokens = tokens.select("row", "pos", "word", F.when(F.col("word") == END, F.col("id")).alias("doc_id"))
    postings = join_sent(tokens, vocab, "word", fits).select("term", "row", "pos", "doc_id")
    return staged(postings.sortWithinPartitions("term", "row", "pos"))


def item_windows(items: DataFrame, window: int = WINDOW, item_id: str = "item_id",
                 text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows ``window, words`` of all items, and ``window, item_id`` of each item's windows.

    A window is ``window`` consecutive words; an item of fewer words, but not none, is one window.
    """
    w = F.col("w")
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - window, F.lit(0)) + 1)
    cut = (items.select(F.col(item_id).alias("item_id"), words(text).alias("w")).filter(F.size(w) > 0)
           .select("item_id", "w", F.explode(starts).alias("at"))
           .select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("words")))
    cut = staged(cut.distinct())
    numbered = staged(cut.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words"))
    return numbered, staged(cut.join(numbered, "words").select("window", "item_id"))


def rarest_first(windows: DataFrame, vocab: DataFrame, index: DataFrame) -> DataFrame:
    """``window, n, terms`` with terms an array of (frequency, offset, term), rarest first.

    A window with a word that the index lacks is left out, as it occurs nowhere.
    """
    n = index.groupBy("term").agg(F.count("*").alias("frequency"))
    known = vocab.join(n, "term").select("word", "term", "frequency")
    one = windows.select("window", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    terms = F.array_sort(F.collect_list(F.struct("frequency", "offset", "term")))
    return staged(one.join(known, "word").groupBy("window", "n").agg(terms.alias("terms"))
                  .filter(F.size("terms") == F.col("n")))


def _lists(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The postings of the wanted terms, each with the rows of ``wanted`` for its term."""
    return join_sent(index.select("term", "row", "pos"), wanted, "term", wanted.count() <= SENT_ROWS)


def _ask(found: DataFrame, windows: DataFrame) -> DataFrame:
    """Candidates with what their windows look up next; a window may have most of the candidates."""
    return join_sent(found, windows, "window", windows.count() * WINDOW <= SENT_ROWS)


def phrase_matches(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """All occurrences ``row, window, n, start`` of the windows.

    The list of a window's rarest term, shifted back by the term's offset, gives the candidate starts.
    It is intersected with the shifted list of the next rarest term, then of all others at once. Only
    terms of windows that still have candidates are read; what meets is keyed by document and position,
    of which every posting has its own, so that a frequent term is no hot key.
    """
    at = ["row", "window", "n", "start"]
    first = ranked.select("window", "n", F.col("terms")[0].alias("t")).select("window", "n", "t.offset", "t.term")
    found = _lists(index, first).withColumn("start", F.col("pos") - F.col("offset")).select(at).filter("start >= 0")
    for done, length in ((1, F.lit(1)), (2, F.greatest(F.col("n") - 2, F.lit(0)))):
        found = staged(found)
        rest = staged(ranked.join(found.select("window").distinct(), "window", "left_semi")
                      .select("window", F.slice("terms", F.lit(done + 1), length).alias("rest")))
        asked = _ask(found, rest)
        need = asked.select(*at, F.size("rest").alias("of"), F.explode("rest").alias("t")).select(
            *at, "of", (F.col("start") + F.col("t.offset")).alias("pos"), "t.term")
        lists = _lists(index, staged(rest.select(F.explode("rest.term").alias("term")).distinct()))
        met = need.join(lists, ["row", "pos", "term"]).groupBy(*at, "of").count().filter("count = of").select(at)
        found = met.unionByName(asked.filter(F.size("rest") == 0).select(at))
    return staged(found)


def proximity_matches(index: DataFrame, ranked: DataFrame, within: int) -> DataFrame:
    """``row, window, anchor``: a window's words, repeats included, all among ``within`` words on either side of ``anchor``.

    The anchor is an occurrence of the window's rarest term; order does not count. The other terms are
    looked up rarest first; each needs as many postings near the anchor as the window has of it.
    A candidate's key is the document and a stretch of positions, each anchor asks its own and both next.
    """
    counts = ranked.select("window", F.explode("terms").alias("t")).groupBy("window", "t.term").agg(
        F.count("*").alias("times"), F.min("t.frequency").alias("frequency"))
    order = Window.partitionBy("window").orderBy("frequency", "term")
    counts = staged(counts.withColumn("rank", F.row_number().over(order)))
    found = _lists(index, counts.filter("rank = 1").select("window", "term")).select("row", "window", F.col("pos").alias("anchor"))
    most = counts.agg(F.max("rank")).first()[0] or 0
    stretch = lambda at: F.floor(at / F.lit(within + 1))
    for rank in range(1, most + 1):
        found = staged(found)
        now = staged(counts.filter(F.col("rank") == rank).join(found.select("window").distinct(), "window", "left_semi")
                     .select("window", "term", "times"))
        lists = _lists(index, now.select("term").distinct()).withColumn("stretch", stretch(F.col("pos")))
        asked = _ask(found, now).withColumn(
            "stretch", F.explode(F.array(*[stretch(F.col("anchor")) + i for i in (-1, 0, 1)])))
        near = (asked.join(lists, ["row", "term", "stretch"]).filter(F.abs(F.col("pos") - F.col("anchor")) <= within)
                .groupBy("row", "window", "anchor", "times").agg(F.count("*").alias("met")).filter("met >= times"))
        done = found.join(now.select("window"), "window", "left_anti")  # windows with fewer distinct terms
        found = near.select("row", "window", "anchor").unionByName(done)
    return staged(found)


def _covered(matches: DataFrame) -> DataFrame:
    """``row, n_hit``: positions inside any match; a document has at most ten matches a start."""
    spans = matches.groupBy("row", "start").agg(F.max("n").alias("n"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    fresh = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    return (spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("row")
            .agg(F.sum("fresh").cast("long").alias("n_hit")))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word of a document is hit when it lies inside an occurrence of a window of any item. Null or empty
    texts have no words and are clean; items without words match nothing. Repeated documents are
    judged each; repeated item ids count once, and items with a null id hit words but are not
    counted or listed. An empty table of documents gives no rows, one of items leaves all clean. Other
    columns are not read.
    """
    vocab = vocabulary(items, item_text)
    index = build_index(docs, vocab, doc_id, text)
    windows, owners = item_windows(items, window, item_id, item_text)
    matches = phrase_matches(index, rarest_first(windows, vocab, index))
    which = join_sent(matches.select("row", "window").distinct(), owners.filter("item_id IS NOT NULL"), "window",
                      owners.count() <= SENT_ROWS)
    items_of = which.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    ends = index.filter(F.col("term") == END_TERM).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return (ends.join(_covered(matches), "row", "left").join(items_of, "row", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                    F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")))
