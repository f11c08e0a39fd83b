"""Personal data: fixed patterns, and words that the corpus ties to a person's data.

Only DataFrame functions run here. Whether a word gives an identifier away is judged by pointwise
mutual information over the whole corpus: for an identifier ``e`` found in ``n(e)`` of ``N``
documents and a word ``t`` found in ``n(t)`` of them, ``n(t, e)`` times near ``e``,

    disclosure(t, e) = log(n(t, e) * N / (n(t) * n(e))) / log(N / n(e)),

the share of what ``e`` tells that ``t`` tells already: 1 if ``t`` occurs with ``e`` only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Step, empty_if_null

KINDS = ("email", "ip", "card", "phone")

# Each pattern finds what its plain form finds, without backtracking over long runs:
# \G lets a match begin inside a run only where the one before has ended.
_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_DOMAIN}]++\.[{_DOMAIN}]"
    rf"[{_DOMAIN}.]*?(?=\.\.|\.?+(?![{_DOMAIN}.]))",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]*?(?<=[0-9])(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot hold a match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

SPAN = "array<struct<start:bigint,stop:bigint,match:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Limits of the judgement on words.

    ``reach``: words on each side of an identifier that count as near it. ``support``: different
    texts in which word and identifier must meet, so that copies of one text prove nothing.
    From ``generalise`` on a word is replaced by its class, from ``remove`` on it is removed.
    """

    reach: int = 5
    support: int = 3
    generalise: float = 0.5
    remove: float = 0.9


def _luhn(digits: Column) -> Column:
    size = F.length(digits)
    values = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.substring(digits, size - i, F.lit(1)).cast("int") * (i % 2 + 1),
    )
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """What a match has to fulfil besides its pattern."""
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, r"[\x20-]", "")
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _matches(text: Column, pattern: Column, needs: str | None) -> Column:
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return found if needs is None else F.when(F.contains(text, F.lit(needs)), found)


# Elements of an array that are added up at once, and code points of a block of text.
STRETCH, BLOCK = 256, 4_096


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """Running totals of an array of bigints, none of them NULL.

    Totals grow within stretches only, and what comes before a stretch is added to its totals
    afterwards, so a long array is not copied for each of its elements.
    """

    def grown(part: Column) -> Column:
        first = F.slice(part, 1, 1)
        rest = F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0)))
        return F.aggregate(
            rest, first, lambda done, x: F.array_append(done, combine(F.element_at(done, -1), x))
        )

    def joined(parts: Column) -> Column:
        ends = F.transform(parts, lambda p: F.element_at(p, -1))
        before = _running(ends, combine, levels - 1) if levels else grown(ends)
        return _once(
            before,
            lambda sums: F.flatten(
                F.transform(
                    parts,
                    lambda p, i: F.when(i == 0, p).otherwise(
                        F.transform(p, lambda x: combine(F.get(sums, i - 1), x))
                    ),
                )
            ),
        )

    def cut(array: Column) -> Column:
        last = F.floor((F.size(array) - 1) / STRETCH).cast("int")
        starts = F.sequence(F.lit(0), last)
        return F.transform(starts, lambda i: grown(F.slice(array, i * STRETCH + 1, STRETCH)))

    return _once(
        values,
        lambda array: F.when(F.size(array) > STRETCH, _once(cut(array), joined)).otherwise(
            grown(array)
        ),
    )


def _placed(text: Column, pattern: Column, matches: Column) -> Column:
    """Matches with their places, from the lengths of the pieces between them."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    lengths = F.zip_with(
        F.slice(gaps, 1, F.size(matches)), matches,
        lambda gap, match: (gap + F.char_length(match)).cast("bigint"),
    )
    stops = _running(lengths, lambda a, b: a + b)
    spans = F.zip_with(
        stops, matches,
        lambda stop, match: F.struct(
            (stop - F.char_length(match)).alias("start"), stop.alias("stop"), match.alias("match")
        ),
    )
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(SPAN))


def _blocks(text: Column) -> Column:
    """A text in blocks, of which parts are taken without going through the whole of it."""
    last = F.floor(F.char_length(text) / BLOCK).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * BLOCK + 1, F.lit(BLOCK))
    )


def _part(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` of a text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    n = F.floor(stop / BLOCK).cast("int") - first + 1
    held = F.array_join(F.slice(blocks, first + 1, n), "")
    return F.substring(held, (start - first * BLOCK + 1).cast("int"), (stop - start).cast("int"))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with a column per kind: the spans of the fixed patterns in ``text``.

    A span is (start, stop, match) in code points, stop exclusive; a NULL text has none.
    """
    text = empty_if_null("text")
    docs = docs.withColumns(
        {f"_{k}": _matches(text, F.lit(PATTERNS[k]), NEEDS[k]) for k in KINDS}
    )

    def held(kind: str) -> Column:
        placed = _placed(text, F.lit(PATTERNS[kind]), F.col(f"_{kind}"))
        return F.filter(placed, lambda s: _holds(kind, s["match"]))

    return docs.withColumns({k: held(k) for k in KINDS}).drop(*[f"_{k}" for k in KINDS])


def _tagged(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
            s["match"].alias("match"),
        ),
    )


def span_list(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def _word(raw: Column) -> Column:
    return F.lower(F.regexp_replace(raw, r"^\P{L}+|\P{L}+$", ""))


def _words(text: Column) -> Column:
    """The distinct words of a text: runs between white space, bare of other than letters."""
    words = F.transform(F.split(text, r"\s+"), _word)
    return F.array_distinct(F.filter(words, lambda w: w.rlike(r"^\p{L}{3,}$")))


def _near(text: Column, blocks: Column, span: Column, reach: int) -> Column:
    """Words that begin or end within ``reach`` words of the span.

    A block on each side is enough, unless it holds fewer words than that.
    """
    size = F.char_length(text)

    def around(first: Column, last: Column) -> tuple[Column, Column]:
        before = F.split(F.rtrim(_part(blocks, first, span["start"])), r"\s+")
        after = F.split(F.ltrim(_part(blocks, span["stop"], last)), r"\s+")
        return before, after

    def ends(before: Column, after: Column) -> Column:
        tail = F.slice(before, F.greatest(F.size(before) - reach + 1, F.lit(1)), reach)
        return F.array_join(F.concat(tail, F.slice(after, 1, reach)), " ")

    first = F.greatest(span["start"] - BLOCK, F.lit(0))
    last = F.least(span["stop"] + BLOCK, size.cast("bigint"))
    before, after = around(first, last)
    # The outermost word of what was taken may be cut.
    enough = ((first == 0) | (F.size(before) > reach)) & ((last == size) | (F.size(after) > reach))
    whole = around(F.lit(0).cast("bigint"), size.cast("bigint"))
    return _words(F.when(enough, ends(before, after)).otherwise(ends(*whole)))


def telling_words(found: DataFrame, docs: DataFrame, limits: Disclosure) -> DataFrame:
    """(entity, term, disclosure) of the words that reach the lower limit.

    ``found`` holds the documents with identifiers: ``key``, ``text`` and ``base``, their spans.
    Counts of words and documents cover all of ``docs``, copies included.
    """
    def beside(blocks: Column) -> Column:
        """The words near each span; rows leave a document without its text."""
        return F.transform(
            "base",
            lambda s: F.struct(
                _entity(s).alias("entity"),
                _near(F.col("text"), blocks, s, limits.reach).alias("terms"),
            ),
        )

    met = found.select(
        "key", F.xxhash64("text").alias("digest"),
        F.explode(_once(_blocks(F.col("text")), beside)).alias("met"),
    ).select("key", "digest", "met.entity", F.explode("met.terms").alias("term"))
    met = met.groupBy("entity", "term", "digest", "key").agg(F.count("*").alias("n"))
    pairs = met.groupBy("entity", "term", "digest").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("n_both"), F.count("*").alias("n_texts")
    ).where(F.col("n_texts") >= limits.support)
    entities = found.select("key", F.explode("base").alias("span")).select(
        "key", _entity(F.col("span")).alias("entity")
    ).distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = docs.select(F.explode(_words(empty_if_null("text"))).alias("term"))
    words = words.groupBy("term").agg(F.count("*").alias("n_term"))
    total = docs.agg(F.count("*").alias("n_all"))
    counted = pairs.join(entities, "entity").join(words, "term").join(F.broadcast(total))
    told = F.log(F.col("n_both") * F.col("n_all") / (F.col("n_term") * F.col("n_entity")))
    share = F.when(
        F.col("n_all") > F.col("n_entity"), told / F.log(F.col("n_all") / F.col("n_entity"))
    )
    return counted.select("entity", "term", share.alias("disclosure")).where(
        F.col("disclosure") >= limits.generalise
    )


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.lower(span["match"]))


def find_personal_data(docs: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """(row, key, base, terms) for each document; ``row`` is the document as it was given.

    ``base`` are the spans of the fixed patterns by kind, then start; ``terms`` those of telling
    words in documents that hold the identifier, with kind ``term`` or, from the upper limit on,
    ``removed``; a word inside a base span is none. Columns of ``docs`` may have any name and
    type; a NULL text has no spans; repeated rows count and come out as often as they are given.

    Documents are written once with their base spans. Only those with identifiers, and lists of
    words without their texts, are shuffled for the rest.
    """
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    spans = base_spans(rows.select("row", text.alias("text")))
    step = Step(
        spans.select(
            "row",
            F.monotonically_increasing_id().alias("key"),
            F.concat(*[_tagged(k, F.col(k)) for k in KINDS]).alias("base"),
        ),
        "personal",
    ).df
    found = step.where(F.size("base") > 0).select("key", text.alias("text"), "base")
    told = telling_words(found, docs.select("text"), limits)
    here = found.select("key", F.explode("base").alias("span")).select(
        "key", _entity(F.col("span")).alias("entity")
    ).distinct()
    risky = here.join(told, "entity").groupBy("key", "term").agg(
        F.max("disclosure").alias("disclosure")
    )
    risky = risky.groupBy("key").agg(
        F.sort_array(F.collect_list("term")).alias("words"),
        F.collect_set(F.when(F.col("disclosure") >= limits.remove, F.col("term"))).alias("gone"),
    )
    pattern = F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("words", "|"), F.lit(r")(?!\p{L})")
    )
    hits = found.join(risky, "key").withColumn("pattern", pattern)
    hits = hits.withColumn("matches", _matches(F.col("text"), F.col("pattern"), None))
    placed = _placed(F.col("text"), F.col("pattern"), F.col("matches"))
    free = F.filter(
        placed,
        lambda s: ~F.exists(
            "base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])
        ),
    )
    terms = F.transform(
        free,
        lambda s: F.struct(
            F.when(F.array_contains("gone", F.lower(s["match"])), "removed")
            .otherwise("term").alias("kind"),
            s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match"),
        ),
    )
    named = hits.select("key", terms.alias("terms"))
    kind = step.schema["base"].dataType
    return step.join(named, "key", "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast(kind))
    )


def _disjoint(spans: Column) -> Column:
    """Spans by start, those that overlap joined under the kind that starts first."""
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                               s["kind"].alias("kind")),
        )
    )

    def joined(spans: Column) -> Column:
        return _once(
            _running(F.transform(spans, lambda s: s["stop"]), lambda a, b: F.greatest(a, b)),
            lambda stops: _once(firsts(spans, stops), lambda at: groups(spans, stops, at)),
        )

    def firsts(spans: Column, stops: Column) -> Column:
        """Places of the spans that begin where all before them have ended."""
        places = F.sequence(F.lit(0), F.size(spans) - 1)
        return F.filter(places, lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(stops, i - 1)))

    def groups(spans: Column, stops: Column, at: Column) -> Column:
        def group(i: Column, n: Column) -> Column:
            last = F.coalesce(F.get(at, n + 1), F.size(spans)) - 1
            first = F.get(spans, i)
            return F.struct(
                first["start"].alias("start"), F.get(stops, last).alias("stop"),
                first["kind"].alias("kind"),
            )

        return F.transform(at, group)

    none = F.array().cast("array<struct<start:bigint,stop:bigint,kind:string>>")
    return _once(ordered, lambda v: F.when(F.size(v) > 0, joined(v)).otherwise(none))


def sanitised(docs: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with the spans of :func:`find_personal_data` replaced in ``text``.

    An identifier becomes its kind in angle brackets, a telling word ``<term>``, or nothing from
    the upper limit on. Texts without spans, NULL ones too, stay as they are; all rows and columns
    are kept.
    """
    found = find_personal_data(docs, limits)
    spans = _disjoint(F.concat("base", "terms"))
    found = found.withColumn("spans", spans)
    text = F.col("row")["text"]

    def changed(blocks: Column, spans: Column) -> Column:
        last = F.element_at(spans, -1)["stop"]
        rest = F.substring(text, (last + 1).cast("int"), F.char_length(text))
        pieces = F.transform(spans, lambda s, i: piece(blocks, spans, s, i))
        return F.concat(F.array_join(pieces, ""), rest)

    def piece(blocks: Column, spans: Column, s: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(spans, i - 1)["stop"]).otherwise(F.lit(0))
        gap = _part(blocks, before, s["start"])
        label = F.when(s["kind"] == "removed", "").otherwise(
            F.concat(F.lit("<"), s["kind"], F.lit(">"))
        )
        return F.concat(gap, label)

    made = _once(_blocks(text), lambda b: _once(F.col("spans"), lambda v: changed(b, v)))
    new = F.when(F.size("spans") > 0, made).otherwise(text)
    return found.select(
        *[
            (new if c == "text" else F.col("row")[c]).alias(c)
            for c in docs.columns
        ]
    )
