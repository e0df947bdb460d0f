"""Quality rules: how far a document's letters and common words lie from those of its language.

Every measure is an expression over one row, so the operator adds no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import log2
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import SPACE, WORD, free_names, let

# Character classes, as ranges of a regular expression. White space is not counted; what no class
# has is "other".
CLASSES = {
    "lower": r"a-zß-öø-ÿ",
    "upper": r"A-ZÀ-ÖØ-Þ",
    "digit": r"0-9",
    "punctuation": r".,;:!?'\"()\-¿¡«»’“”",
}
CLASS_NAMES = (*CLASSES, "other")
# Share of each class in running prose, in the order of CLASS_NAMES.
CLASS_REFERENCE = {
    "en": (0.930, 0.030, 0.010, 0.028, 0.002),
    "de": (0.905, 0.055, 0.010, 0.028, 0.002),
    "fr": (0.925, 0.030, 0.010, 0.033, 0.002),
    "es": (0.928, 0.030, 0.010, 0.030, 0.002),
}
# Share of the commonest words among all words of running prose.
WORD_REFERENCE = {
    "en": {"the": 0.060, "of": 0.032, "and": 0.028, "to": 0.026, "a": 0.023, "in": 0.021, "that": 0.011, "is": 0.011,
           "was": 0.009, "it": 0.009, "for": 0.009, "with": 0.007},
    "de": {"der": 0.032, "die": 0.032, "und": 0.028, "in": 0.018, "den": 0.012, "von": 0.011, "zu": 0.011, "das": 0.010,
           "mit": 0.009, "sich": 0.009, "ist": 0.008, "des": 0.008},
    "fr": {"de": 0.048, "la": 0.030, "le": 0.024, "et": 0.022, "les": 0.020, "des": 0.017, "en": 0.014, "un": 0.011,
           "du": 0.011, "une": 0.010, "que": 0.010, "dans": 0.008},
    "es": {"de": 0.060, "la": 0.038, "que": 0.030, "el": 0.028, "en": 0.026, "y": 0.025, "los": 0.016, "se": 0.012,
           "del": 0.011, "las": 0.011, "un": 0.010, "con": 0.009},
}
EDGES = ".,;:!?'\"()-¿¡«»’“”"
SYMBOLS = r"[#*$%&|<>]"

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_CLASS_DIVERGENCE = 0.12
# Shorter texts have histograms too coarse to judge.
MIN_JUDGED_CHARS = 200
MIN_JUDGED_WORDS = 100


def _without_common_words(shares: Iterable[float]) -> float:
    """The divergence of a text that has none of the common words, from a reference that gives them these shares."""
    rest = 1 - sum(shares)
    return (sum(shares) + log2(2 / (1 + rest)) + rest * log2(2 * rest / (1 + rest))) / 2


# As far as a text goes that has next to none of its language's common words, and no others in their place.
MAX_WORD_DIVERGENCE = {lang: round(0.995 * _without_common_words(words.values()), 6) for lang, words in WORD_REFERENCE.items()}


def js_divergence(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon divergence in bits, 0 to 1; terms of an empty bin are 0."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    return reduce(add, (term(a, b) + term(b, a) for a, b in zip(p, q, strict=True))) / 2


def _per_language(lang: Column, values: dict) -> Column:
    """The value of a row's language; null for a language without a reference."""
    return reduce(lambda rest, item: F.when(lang == item[0], F.lit(item[1])).otherwise(rest),
                  values.items(), F.lit(None))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the array, the first one included.

    Windows are compared by a 64-bit hash. Most texts repeat none, and then no sort is needed.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, size)))

    def covered(positions: Column) -> Column:
        steps = F.transform(positions, lambda p, i: F.least(
            F.lit(size), F.coalesce(F.get(positions, i + 1) - p, F.lit(size))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def twice(pairs: Column) -> Column:
        return F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"])
                        | (F.get(pairs, i + 1)["h"] == x["h"]))

    def of_windows(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        places = let(pairs, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["at"])))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(let(places, covered)))

    return F.when(F.size(words) < size, F.lit(0).cast("long")).otherwise(let(hashes, of_windows))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", into: str = "quality") -> DataFrame:
    """Add a struct column ``into`` with the measures and the verdict of every row.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_divergence, word_divergence,
    base_failed, kept. ``kept`` needs both: the base rules hold, and neither divergence that can be judged exceeds
    its bound. A divergence is null, and then does not count, for a text below MIN_JUDGED_CHARS or MIN_JUDGED_WORDS
    and for a language that is null or has no reference.

    Null text counts as empty: no words, so base_failed. Repeated rows are judged alike, each by itself. An empty
    table gives an empty table. Other columns pass through whatever their names, except that a column already named
    ``into`` is replaced.
    """
    rest = [c for c in docs.columns if c.lower() != into.lower()]
    # One expression with every step bound to a name: as a chain of columns, a filter on the verdict would be pushed down
    # through it and repeat each step for each use.
    judged = let(F.coalesce(F.col(f"`{text}`"), F.lit("")), lambda t: let(
        _counts(t, F.col(f"`{lang}`")), lambda m: _verdict(m, F.col(f"`{lang}`"))))
    return docs.select(*[F.col(f"`{c}`") for c in rest], judged.alias(into))


def _counts(t: Column, lang: Column) -> Column:
    """The counts of one text, as a struct."""
    def lines(t: Column) -> Column:
        worded = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
        return let(worded, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))

    def without(source: Column, ranges: str) -> Column:
        return F.length(source) - F.length(F.regexp_replace(source, f"[{ranges}]+", ""))

    def characters(chars: Column) -> Column:
        # Lower-case letters are nine tenths of most texts: once they are gone, the other counts are cheap.
        return let(F.regexp_replace(chars, f"[{CLASSES['lower']}]+", ""), lambda other: F.struct(
            F.length(chars).cast("long").alias("all"),
            (F.length(other) - F.length(F.regexp_replace(other, SYMBOLS, ""))).cast("long").alias("symbols"),
            (F.length(chars) - F.length(other)).cast("double").alias("lower"),
            *[without(other, ranges).cast("double").alias(name) for name, ranges in CLASSES.items() if name != "lower"]))

    def common(w: Column) -> Column:
        listed = _per_language(lang, {k: list(v) for k, v in WORD_REFERENCE.items()})
        places = let(listed, lambda known: F.filter(
            F.transform(w, lambda x: F.array_position(known, F.lower(F.btrim(x, F.lit(EDGES))))), lambda at: at > 0))
        return F.when((F.size(w) >= MIN_JUDGED_WORDS) & lang.isin(*WORD_REFERENCE), places)

    return let(F.filter(F.split(t, SPACE), lambda x: x != ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), lines(t).alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"), common(w).alias("places"),
        let(F.regexp_replace(t, SPACE, ""), characters).alias("chars")))


def _verdict(m: Column, lang: Column) -> Column:
    """The result struct from the counts ``m``."""
    chars, n_words, places = m["chars"], m["n_words"], m["places"]
    n_common = len(next(iter(WORD_REFERENCE.values())))
    shares = [chars[name] / chars["all"] for name in CLASSES]
    shares.append((chars["all"] - reduce(add, (chars[name] for name in CLASSES))) / chars["all"])
    expected = [_per_language(lang, {k: v[i] for k, v in CLASS_REFERENCE.items()}) for i in range(len(CLASS_NAMES))]

    def occurrences(i: int) -> Column:
        # A second parameter of the lambda would be the element's place in the array.
        return F.size(F.filter(places, lambda at: at == i + 1))

    word_shares = [occurrences(i) / n_words for i in range(n_common)]
    word_shares.append((n_words - F.size(places)) / n_words)
    word_expected = [_per_language(lang, {k: list(v.values())[i] for k, v in WORD_REFERENCE.items()})
                     for i in range(n_common)]
    word_expected.append(_per_language(lang, {k: 1 - sum(v.values()) for k, v in WORD_REFERENCE.items()}))
    of_chars = F.when((chars["all"] >= MIN_JUDGED_CHARS) & lang.isin(*CLASS_REFERENCE),
                      _divergence_of(shares, expected))
    of_words = F.when(places.isNotNull(), _divergence_of(word_shares, word_expected))
    failed = (n_words < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
    judged = F.struct(failed.alias("base_failed"), of_chars.alias("of_chars"), of_words.alias("of_words"))
    return let(judged, lambda v: F.struct(
        n_words.alias("n_words"), chars["all"].alias("word_chars"), chars["symbols"].alias("n_symbols"),
        m["n_dup_lines"].alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"),
        v["of_chars"].alias("class_divergence"), v["of_words"].alias("word_divergence"),
        v["base_failed"].alias("base_failed"),
        (~v["base_failed"] & (F.coalesce(v["of_chars"], F.lit(0.0)) <= MAX_CLASS_DIVERGENCE)
         & F.coalesce(v["of_words"] <= _per_language(lang, MAX_WORD_DIVERGENCE), F.lit(True))).alias("kept")))


def _divergence_of(p: list[Column], q: list[Column]) -> Column:
    """js_divergence with every share worked out once."""
    values = F.struct(*[x.alias(f"p{i}") for i, x in enumerate(p)], *[x.alias(f"q{i}") for i, x in enumerate(q)])
    return let(values, lambda s: js_divergence([s[f"p{i}"] for i in range(len(p))], [s[f"q{i}"] for i in range(len(q))]))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that pass, with the columns of ``docs``."""
    [into] = free_names(docs.columns, "quality")
    return measure(docs, text, lang, into).filter(F.col(into)["kept"]).drop(into)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def measure_sql(source: str) -> str:
    """DuckDB SQL for doc_id, the measures, base_failed and kept of the rows of ``source`` (doc_id unique)."""
    def by_lang(values: dict, quote=str) -> str:
        return "case lang " + " ".join(f"when '{k}' then {quote(v)}" for k, v in values.items()) + " end"

    def divergence(p: list[str], q: list[str]) -> str:
        one = "case when {a} > 0 then {a} * log2(2 * {a} / ({a} + {b})) else 0.0 end"
        return "(" + " + ".join(f"({one.format(a=a, b=b)} + {one.format(a=b, b=a)})"
                                for a, b in zip(p, q, strict=True)) + ") / 2"

    def count(ranges: str) -> str:
        return f"length(chars) - length(regexp_replace(chars, {_quoted(f'[{ranges}]+')}, '', 'g'))"

    n_common = len(next(iter(WORD_REFERENCE.values())))
    shares = [f"c_{name} / word_chars" for name in CLASSES]
    shares.append("(word_chars - " + " - ".join(f"c_{name}" for name in CLASSES) + ") / word_chars")
    expected = [by_lang({k: v[i] for k, v in CLASS_REFERENCE.items()}) for i in range(len(CLASS_NAMES))]
    word_shares = [f"len(list_filter(places, lambda x: x = {i + 1})) / n_words" for i in range(n_common)]
    word_shares.append("(n_words - len(places)) / n_words")
    word_expected = [by_lang({k: list(v.values())[i] for k, v in WORD_REFERENCE.items()}) for i in range(n_common)]
    word_expected.append(by_lang({k: 1 - sum(v.values()) for k, v in WORD_REFERENCE.items()}))
    listed = by_lang(WORD_REFERENCE, lambda v: "[" + ", ".join(map(_quoted, v)) + "]")
    known = ", ".join(map(_quoted, WORD_REFERENCE))
    return f"""
    with base as (
        select doc_id, lang, coalesce(text, '') as t from {source}
    ), split as (
        select *, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') as w,
               regexp_replace(t, '{SPACE}', '', 'g') as chars,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from base
    ), windows as (
        select doc_id, unnest(range(1, len(w) - {WINDOW - 2})) as pos, w from split where len(w) >= {WINDOW}
    ), grams as (
        select doc_id, pos, list_slice(w, pos, pos + {WINDOW - 1}) as gram from windows
    ), twice as (
        select doc_id, pos from grams qualify count(*) over (partition by doc_id, gram) > 1
    ), gaps as (
        select doc_id, least({WINDOW}, coalesce(lead(pos) over (partition by doc_id order by pos) - pos, {WINDOW})) as n
        from twice
    ), repeats as (
        select doc_id, sum(n) as n from gaps group by doc_id
    ), counted as (
        select doc_id, lang, len(w) as n_words, length(chars) as word_chars,
               length(chars) - length(regexp_replace(chars, '{SYMBOLS}', '', 'g')) as n_symbols,
               len(lines) - len(list_distinct(lines)) as n_dup_lines,
               {", ".join(f"{count(ranges)} as c_{name}" for name, ranges in CLASSES.items())},
               case when len(w) >= {MIN_JUDGED_WORDS} and lang in ({known}) then
                   list_filter(list_transform(w, lambda x: list_position({listed}, lower(trim(x, {_quoted(EDGES)})))),
                               lambda x: x > 0) end as places
        from split
    ), judged as (
        select doc_id, lang, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
               cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
               cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
               case when word_chars >= {MIN_JUDGED_CHARS} and lang in ({known})
                    then {divergence(shares, expected)} end as class_divergence,
               case when places is not null then {divergence(word_shares, word_expected)} end as word_divergence
        from counted left join repeats r using (doc_id)
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
           not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
           and coalesce(class_divergence, 0) <= {MAX_CLASS_DIVERGENCE}
           and coalesce(word_divergence <= {by_lang(MAX_WORD_DIVERGENCE)}, true) as kept
    from judged"""
