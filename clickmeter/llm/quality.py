"""Quality rules by weak supervision, in DataFrame functions only.

Rules look at counts of a text and vote good, bad or abstain. No rule decides. The pattern
of votes of every document is counted; expectation-maximisation over these counts estimates
how often each rule casts each vote on good and on bad documents, and from that every
pattern gets a posterior probability of being good. A rule either votes or abstains, so there are at
most 2^12 patterns whatever the corpus; their table is the only thing that is broadcast.

Defined cases: a null or empty text has no words, fails the base test and is not kept.
Repeated rows each get their own row. An empty table gives an empty table. Columns of the
input are carried along by `kept` whatever their names.
Repeated windows of three words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
GOOD, ABSTAIN, BAD = 2, 1, 0
ROUNDS = 25
PRIOR_GOOD = 0.8
KEEP_FROM = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_distinct_words", "n_capitals", "n_exclaims", "n_letters", "n_bare_words")


def _once(value: Column, use) -> Column:
    """Bind a costly expression to a name, so that a lambda does not evaluate it again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text holds twice or more."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    def ordered(found: Column) -> Column:
        return F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def repeated(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(again, lambda x: x["at"]))

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - at, F.lit(3)))
        )
        return F.aggregate(widths, F.lit(0), lambda total, x: total + x)

    def counted(found: Column) -> Column:
        """Most texts repeat no window, and then nothing needs to be put in order."""
        some = _once(ordered(found), lambda o: _once(repeated(o), covered))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(some)

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    found = _once(hashes, lambda h: _once(windows(h), counted))
    return F.when(F.size(words) >= 3, found).otherwise(0).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[{chars}]+", ""))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the counts that the rules look at."""
    own = [*COUNTS, *MORE_COUNTS, "_text", "_words", "_lines"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    whole = F.coalesce(F.col(text), F.lit(""))
    has_word = f"[^{SPACES}]"
    split = docs.select(
        *kept,
        whole.alias("_text"),
        F.filter(F.split(whole, f"[{SPACES}]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(has_word)).alias("_lines"),
    )
    body, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    values = {
        "n_words": F.size(words),
        "word_chars": _without(body, SPACES),
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_lines": F.size(lines),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_capitals": F.char_length(F.regexp_replace(body, r"\P{Lu}+", "")),
        "n_exclaims": F.char_length(body) - _without(body, "!"),
        "n_letters": F.char_length(F.regexp_replace(body, r"\P{L}+", "")),
        "n_bare_words": F.size(F.filter(words, lambda w: ~w.rlike(r"\p{L}"))),
    }
    return split.select(*kept, *(v.cast("long").alias(name) for name, v in values.items()))


def _bad_if(fired: Column) -> Column:
    return F.when(fired, BAD).otherwise(ABSTAIN)


def _good_if(fired: Column) -> Column:
    return F.when(fired, GOOD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """The votes. Junk comes in kinds that share little, so a rule that looks for one kind
    says nothing about a document without it; rules that look for prose vote good.

    Bounds are comparisons of whole numbers, so that SQL engines agree.
    """
    words, chars, symbols, dup, repeat, lines, distinct, capitals, exclaims, letters, bare = (
        F.col(c) for c in (*COUNTS, *MORE_COUNTS)
    )
    calm = (symbols * 50 <= words) & (exclaims * 50 <= words) & (capitals * 5 <= chars)
    return {
        "symbols": _bad_if(symbols * 10 > words),
        "letters": _bad_if(letters * 4 < chars * 3),
        "bare_words": _bad_if(bare * 5 > words),
        "dup_lines": _bad_if(dup * 10 > lines * 3),
        "repeats": _bad_if(repeat * 4 > words),
        "variety": _bad_if((words >= 50) & (distinct * 10 < words * 3)),
        "capitals": _bad_if(capitals * 10 > chars * 3),
        "exclaims": _bad_if(exclaims * 10 > words),
        "word_length": _bad_if((chars < words * 3) | (chars > words * 12)),
        "prose": _good_if(calm & (letters * 10 >= chars * 8) & (bare * 20 <= words)),
        "fresh_prose": _good_if(calm & (repeat * 5 <= words) & (dup * 5 <= lines)),
        "long_prose": _good_if(calm & (words >= 100) & (distinct * 5 >= words * 2)),
    }


def voted(counts: DataFrame) -> DataFrame:
    """The counts with the base test and the pattern of votes, a digit for each rule."""
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    return counts.withColumns(
        {
            "base_failed": (n < 50) | (repeat * 100 > n * 50),
            "votes": F.concat(*(v.cast("string") for v in rules().values())),
        }
    )


def posteriors(votes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """A row for each pattern of votes: votes, n, p_good.

    The start assumes that a rule casts the vote that suits a class on 0.7 of its documents,
    the other on 0.1, and abstains on 0.2. One document of each kind is added to the
    counts of every rule, so that no rate becomes 0.
    """
    names = list(rules())
    places = list(range(len(names)))
    patterns = votes.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    start = F.array(*([F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7)), F.array(F.lit(0.7), F.lit(0.2), F.lit(0.1))]))
    model = F.struct(
        F.lit(PRIOR_GOOD).alias("prior"),
        F.transform(F.array(*map(F.lit, places)), lambda _: start).alias("rates"),
    )

    def p_good(cast: Column, m: Column) -> Column:
        odds = reduce(
            lambda a, b: a + b,
            [
                F.log(F.get(F.get(F.get(m["rates"], F.lit(j)), F.lit(0)), F.get(cast, F.lit(j))))
                - F.log(F.get(F.get(F.get(m["rates"], F.lit(j)), F.lit(1)), F.get(cast, F.lit(j))))
                for j in places
            ],
            F.log(m["prior"]) - F.log(1 - m["prior"]),
        )
        return 1 / (1 + F.exp(-odds))

    def total(values: Column, of) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + of(x))

    def step(m: Column, table: Column) -> Column:
        weighed = F.transform(
            table,
            lambda x: _once(
                p_good(x["cast"], m),
                lambda p: F.struct(x["cast"].alias("cast"), (x["n"] * p).alias("good"), (x["n"] * (1 - p)).alias("bad")),
            ),
        )

        def updated(w: Column) -> Column:
            def rate(kind: str, j: Column) -> Column:
                return F.transform(
                    F.array(F.lit(BAD), F.lit(ABSTAIN), F.lit(GOOD)),
                    lambda v: (1 + total(F.filter(w, lambda x: F.get(x["cast"], j) == v), lambda x: x[kind]))
                    / (3 + total(w, lambda x: x[kind])),
                )

            good, bad = total(w, lambda x: x["good"]), total(w, lambda x: x["bad"])
            return F.struct(
                ((good + 1) / (good + bad + 2)).alias("prior"),
                F.transform(F.array(*map(F.lit, places)), lambda j: F.array(rate("good", j), rate("bad", j))).alias("rates"),
            )

        return _once(weighed, updated)

    cast = F.transform(F.split(F.col("votes"), ""), lambda x: x.cast("int"))
    table = F.array_sort(F.collect_list(F.struct(F.col("votes"), cast.alias("cast"), F.col("n"))))
    fitted = patterns.agg(table.alias("patterns")).select(
        "patterns",
        F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), model, lambda m, _: step(m, F.col("patterns"))).alias("m"),
    )
    return fitted.select(F.explode("patterns").alias("x"), "m").select(
        "x.votes", "x.n", F.round(p_good(F.col("x.cast"), F.col("m")), 6).alias("p_good")
    )


def kept(docs: DataFrame, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows that the rules keep, with all their columns.

    The corpus is read once to fit the rates and once to filter, so no text is shuffled.
    """
    model = fitted_model(docs, text)
    named = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)]
    rows = voted(counted(docs.select(*named, F.col(text).alias("text"))))
    judged = rows.join(F.broadcast(model.select("votes", "p_good")), "votes")
    return judged.where(~F.col("base_failed") & (F.col("p_good") >= keep_from)).select(
        *(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns))
    )


def fitted_model(docs: DataFrame, text: str = "text") -> DataFrame:
    return written(posteriors(voted(counted(docs.select(F.col(text).alias("text"))))), "quality-model")


def verdicts(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document without its text. The counts are written once and used twice."""
    counts = voted(counted(docs.select(F.col(ids).alias("doc_id"), F.col(text).alias("text")))).drop("text")
    counts = written(counts, "quality-counts")
    return judged_counts(counts, posteriors(counts))


def judged_counts(counts: DataFrame, model: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    rows = counts.join(F.broadcast(model.select("votes", "p_good")), "votes")
    return rows.select(
        "doc_id",
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & (F.col("p_good") >= keep_from)).alias("kept"),
        "votes",
        "p_good",
    )
