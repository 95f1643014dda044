"""Text cut off by field limits (problem 10).

A text that ends in a sentence end or closed markup is whole.  For every other
text the *tail* (last word fragment and the token before it) is weighed against
what the whole corpus does after the same words:

* the corpus vocabulary is kept as a trie in relational form, one row per node
  (prefix) with the occurrences below it, so no vocabulary is ever broadcast or
  collected; nodes are kept per preceding token and over all words;
* a tail is cut when after the same preceding token the corpus nearly always
  (``GOES_ON``) goes on, by longer words below the node of the fragment or by
  further words after it; where the corpus never has the pair, an unknown
  fragment that is a proper node of the trie of all words was cut mid-word;
* length evidence: where unterminated texts of a source pile up at one exact
  length (characters or bytes) that length is a field limit, and an
  unterminated text of that length is cut even if its tail reads well, unless
  it is a closing form that several texts share;
* an opened tag, entity or a broken character at the end is a cut.

Signatures, page marks and other closing forms have no continuation anywhere
in the corpus and so need no list.  Counts run over all documents with
map-side combine; the tail side is joined on (token, fragment).

Nulls: a null or blank text is no case; a null source is a source of its own.
Copies count once as evidence (by hash) and come out under each id.  Tokens
beyond 64 characters are no words.  An empty corpus gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import cut

#: Share of continued occurrences from which an unfinished tail is a cut.
GOES_ON = 0.9
#: The same where the text ends in white space: nobody leaves a blank after a closing word.
GOES_ON_BLANK = 0.5
#: A length is a field limit of a source when at least this many, and this
#: share, of its unterminated texts have exactly that length.
LIMIT_TEXTS, LIMIT_SHARE = 3, 0.1
#: A fragment is no word of its own when words below its node are this much commoner.
RARE_WORD = 20
#: "9." ends a sentence unless the corpus goes on after such numbers this much more often.
NUMBER_STOPS = 1000
MAX_WORD = 64

# Words (with the numbers after them folded to '#'), numbers, line ends, marks.
TOKEN = r"(?U)(?:\p{L}+(?:['’]\p{L}+)*(?: ?[0-9](?:[0-9.,/]*[0-9])?)?|[0-9](?:[0-9.,/]*[0-9])?|\n|[^\p{L}\p{N}\s])"
TERMINAL = r"(?U)(?:[.?!…](?<![0-9]\.)|[)\]}\"'»”>]|(?:-{2,}))\s*$"
BROKEN = r"(?:<[^<>]{0,30}|&#?[A-Za-z0-9]{0,8}|\\(?:u[0-9A-Fa-f]{0,3})?|�)\s*$"


def tokens(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.regexp_replace(t, r" ?[0-9][0-9.,/]*", "#"))


def tails(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Per non-blank text its ending: last tokens, lengths, marks."""
    t = F.col(text)
    ends_number = t.rlike(r"[0-9]\.\s*$")
    whole = F.when(ends_number, F.regexp_replace(t, r"\.\s*$", "")).otherwise(t)
    # The last two tokens are right as soon as a third one starts before them;
    # else (long blanks, long tokens) the whole text is read.
    near = tokens(whole.substr(F.greatest(F.length(whole) - 120, F.lit(1)), F.lit(121)))
    tok = F.when((F.size(near) > 2) | (F.length(whole) <= 121), near).otherwise(tokens(whole))
    return (
        documents.where(t.isNotNull() & (F.trim(t) != ""))
        .select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.length(t).alias("n_chars"),
            F.octet_length(t).alias("n_bytes"),
            F.xxhash64(t).alias("hash"),
            (t.rlike(TERMINAL) & ~t.rlike(BROKEN)).alias("terminal"),
            t.rlike(BROKEN).alias("broken"),
            ends_number.alias("ends_number"),
            t.rlike(r"\s$").alias("blank_end"),
            tok.alias("_tok"),
        )
        .withColumn("fragment", F.try_element_at("_tok", F.lit(-1)))
        .withColumn("before", F.coalesce(F.try_element_at("_tok", F.lit(-2)), F.lit("\n")))
        .drop("_tok")
    )


def continuations(documents: DataFrame, text: str) -> DataFrame:
    """(before, fragment, n_on, n_stop) over all inner positions of all texts."""
    tok = F.concat(F.array(F.lit("\n")), tokens(F.col(text)))
    inner = documents.where(F.col(text).isNotNull()).select(tok.alias("_t"))
    # The last token of a text is left out: only what has a follower counts.
    grams = F.zip_with(
        F.slice("_t", 1, F.greatest(F.size("_t") - 2, F.lit(0))),
        F.zip_with(
            F.slice("_t", 2, F.greatest(F.size("_t") - 2, F.lit(0))),
            F.slice("_t", 3, F.greatest(F.size("_t") - 2, F.lit(0))),
            lambda b, c: F.struct(b.alias("b"), c.isin(".", "?", "!", "\n", "…", "<").alias("stop")),
        ),
        lambda a, bc: F.struct(a.alias("before"), bc["b"].alias("fragment"), bc["stop"].alias("stop")),
    )
    return (
        inner.select(F.explode(grams).alias("_g"))
        .select("_g.*")
        .groupBy("before", "fragment")
        .agg(F.count_if(~F.col("stop")).alias("n_on"), F.count_if("stop").alias("n_stop"))
    )


def trie(words: DataFrame, keys: list[str]) -> DataFrame:
    """Trie nodes as rows: (keys, fragment, n_below) for every proper prefix.

    ``words`` has the keys, ``fragment`` and the weight ``n``.  A word with
    digits after it ('type#') lies below the bare word.
    """
    prefix = F.explode(F.expr("transform(sequence(1, length(fragment) - 1), i -> substr(fragment, 1, i))"))
    return (
        words.where((F.length("fragment") > 1) & (F.length("fragment") <= MAX_WORD))
        .select(*keys, prefix.alias("prefix"), "n")
        .groupBy(*keys, "prefix")
        .agg(F.sum("n").alias("n_below"))
        .withColumnRenamed("prefix", "fragment")
    )


def limits(open_tails: DataFrame) -> DataFrame:
    """(source, unit, length) at which unterminated texts of a source pile up."""
    long = open_tails.select(
        "source",
        F.explode(
            F.array(
                F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("length")),
                F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("length")),
            )
        ).alias("_l"),
        "hash",
    ).select("source", "_l.unit", "_l.length", "hash")
    counted = long.distinct().groupBy("source", "unit", "length").agg(F.count(F.lit(1)).alias("n"))
    total = counted.groupBy("source", "unit").agg(F.sum("n").alias("total"))
    return (
        counted.alias("c")
        .join(total.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")) & (F.col("c.unit") == F.col("t.unit")))
        .where((F.col("n") >= LIMIT_TEXTS) & (F.col("n") >= LIMIT_SHARE * F.col("total")))
        .select("c.source", "c.unit", "c.length", "n")
    )


def truncated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every cut text: (doc_id, source, evidence)."""
    tail = tails(documents, doc_id, text, source)
    open_tail = cut(tail.where(~F.col("terminal")))
    grams = cut(continuations(documents, text))
    asked = open_tail.select("before", "fragment").distinct()
    alike = open_tail.select("before", "fragment", "hash").distinct()
    endings = alike.groupBy("before", "fragment").agg(F.count(F.lit(1)).alias("n_ends"))
    # Nodes are made for what follows the last-but-one token of some open text.
    after = grams.join(asked.select("before").distinct(), "before", "left_semi").withColumn("n", F.col("n_on") + F.col("n_stop"))
    nodes = trie(after, ["before"]).join(asked, ["before", "fragment"], "left_semi")
    vocabulary = grams.groupBy("fragment").agg(F.sum(F.col("n_on") + F.col("n_stop")).alias("n"))
    fragments = asked.select("fragment").distinct()
    anywhere = trie(vocabulary.where(F.col("fragment").rlike(r"(?U)^\p{L}")), []).join(fragments, "fragment", "left_semi")
    known = vocabulary.join(fragments, "fragment", "left_semi")
    judged = (
        open_tail.join(grams, ["before", "fragment"], "left")
        .join(nodes, ["before", "fragment"], "left")
        .join(endings, ["before", "fragment"], "left")
        .join(anywhere.withColumnRenamed("n_below", "n_anywhere"), "fragment", "left")
        .join(known.withColumnRenamed("n", "n_word"), "fragment", "left")
    )
    zero = F.lit(0).cast("long")
    n_stop, n_word, n_anywhere = (F.coalesce(c, zero) for c in ("n_stop", "n_word", "n_anywhere"))
    n_on = F.coalesce("n_on", zero) + F.coalesce("n_below", zero)
    letter = F.col("fragment").rlike(r"(?U)^\p{L}+(?:['’]\p{L}*)*$")
    share = F.when(F.col("blank_end"), GOES_ON_BLANK).otherwise(GOES_ON)
    goes_on = (n_on > 0) & (n_on >= share * (n_on + n_stop + F.col("n_ends")))
    evidence = (
        F.when(F.col("broken"), F.lit("markup"))
        # A number with a point after it may be a sentence end or half a decimal.
        .when(F.col("ends_number"), F.when((n_on > 0) & (n_stop * NUMBER_STOPS <= n_on), F.lit("sentence")))
        .when(goes_on, F.when(letter & (n_word * RARE_WORD < n_anywhere), F.lit("word")).otherwise(F.lit("sentence")))
        .when(letter & (n_on + n_stop == 0) & (n_word * RARE_WORD < n_anywhere), F.lit("word"))
        .when(F.col("fragment").isin(",", ":", "(", "/", "="), F.lit("sentence"))
    )
    closing = (n_on * 10 < F.col("n_ends")) & (F.col("n_ends") >= LIMIT_TEXTS)
    judged = cut(
        judged.select("doc_id", "source", "n_chars", "n_bytes", "hash", "ends_number", evidence.alias("evidence"), closing.alias("closing"))
    )
    limit = cut(limits(judged.where(F.col("evidence").isNotNull() & ~F.col("ends_number"))))
    at_limit = (
        judged.alias("j")
        .join(
            limit.alias("l"),
            F.col("j.source").eqNullSafe(F.col("l.source"))
            & (F.col("l.length") == F.when(F.col("l.unit") == "chars", F.col("j.n_chars")).otherwise(F.col("j.n_bytes"))),
            "left_semi",
        )
        .where(F.col("evidence").isNull() & ~F.col("ends_number") & ~F.coalesce("closing", F.lit(False)))
        .select("doc_id", "source", F.lit("length").alias("evidence"))
    )
    return judged.where(F.col("evidence").isNotNull()).select("doc_id", "source", "evidence").unionByName(at_limit)


def truncation_rates(documents: DataFrame, found: DataFrame, source: str = "source") -> DataFrame:
    """Documents and cut documents per source."""
    total = documents.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    lost = found.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("n_cut"))
    return total.join(lost, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "n_docs", F.coalesce("n_cut", F.lit(0).cast("long")).alias("n_cut")
    )
