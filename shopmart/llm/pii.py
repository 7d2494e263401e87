"""Personal data: patterns, and the terms of the corpus that give a protected entity away.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers found by pattern and
checked (parts, Luhn digits, number of digits). Their values are the protected entities. A term that
stands next to an entity discloses it by the information that is left about the entity once the term is known:

    left = ic(entity) - pmi(entity; term) = -log2 p(entity | term)
    pmi = log2(p(entity | term) / p(entity)),  ic = -log2 p(entity),  disclosure = 2 ** -left

1 means that the term always stands next to the entity and nothing is left. The chance of the entity cancels, so unrelated
text changes no disclosure. ``p(entity | term)`` is the share of the term's occurrences, in all documents and copies
included, that stand next to the entity; an occurrence between two spans of one entity counts once.
A context is the words around a span; copies of a passage have equal contexts. Terms with at least ``MIN_CONTEXTS``
different contexts are removed from ``REMOVE_AT`` on (0.07 bits left) and generalised (to the kind of the entity) from
``GENERALISE_AT`` on (half a bit left), wherever they stand in any document.

Positions without Python: the pieces between the matches of a pattern and the matches
themselves have lengths in code points, whose running sums are the spans. Patterns are written with
possessive quantifiers and guarded starts: they match what the plain ones match, without
backtracking over long runs and without recursion. ``\\G`` lets a match begin where the one before ended.

Defined cases: null text is empty and has no spans; texts of any length are read whole; rows with the same id are treated one by
one; identifiers have any type and other columns any names; terms of equal disclosure of several kinds are generalised to the last kind by
name; documents without entities still get the spans of disclosing terms; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm.quality_rules import bound
from shopmart.llm.storage import store

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that each match of a pattern passes.
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: A term is a run of letters and digits with a letter in it, read in lower case.
_NO_TERM, _TERM = r"[^\p{L}\p{N}]+", r"[\p{L}\p{N}]+"
CONTEXT_WORDS = 4
CONTEXT_CHARS = 120
MIN_CONTEXTS = 3
GENERALISE_AT = 0.7
REMOVE_AT = 0.95


_SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string,instead:string>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number is right."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(
        F.filter(backwards, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike("^" + r"\.".join([_PART] * 4) + "$")
    if kind == "card":
        return F.when(F.length(_digits(match)).between(14, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _spans(text: Column, pattern: Column) -> Column:
    """Array of (start, end, value) of the matches of a pattern: code points, end exclusive."""

    def placed(matches: Column) -> Column:
        def from_pieces(pieces: Column) -> Column:
            steps = F.transform(
                matches, lambda m, i: F.struct(F.length(F.get(pieces, i)).alias("gap"), F.length(m).alias("own"), m.alias("value"))
            )
            nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

            def add(state: Column, step: Column) -> Column:
                start = state["at"] + step["gap"]
                span = F.struct(start.alias("start"), (start + step["own"]).alias("end"), step["value"].alias("value"))
                return F.struct((start + step["own"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

            return F.aggregate(steps, nothing, add, lambda state: state["spans"])

        return bound(F.split(text, pattern, -1), from_pieces)

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    return bound(matches, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(empty))


def base_spans(text: Column) -> Column:
    """Checked pattern matches by start, then kind: array of (start, rank, kind, end, value)."""
    empty = F.array().cast(f"array<{_SPAN}>")

    def of_kind(rank: int, kind: str) -> Column:
        hint = F.contains(text, F.lit(_HINTS[kind])) if kind in _HINTS else text.rlike("[0-9][ -]?[0-9]")
        valid = F.filter(_spans(text, F.lit(PATTERNS[kind])), lambda s: _valid(kind, s["value"]))
        named = F.transform(
            valid,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                F.lit(kind).alias("kind"),
                s["end"].alias("end"),
                s["value"].alias("value"),
                F.lit(f"<{kind}>").alias("instead"),
            ),
        )
        return F.when(hint, named).otherwise(empty)

    return F.array_sort(F.concat(*[of_kind(rank, kind) for rank, kind in enumerate(KINDS)]))


def terms_of(text: Column) -> Column:
    return F.split(F.lower(text), _NO_TERM)


def _context(text: Column, span: Column) -> Column:
    """The terms next to a span, nearest first on each side: array of (term, at), where they start in the text."""
    reach = F.least(span["start"], F.lit(CONTEXT_CHARS))

    def side(start: Column, length: Column) -> Column:
        found = _spans(F.substring(text, start + 1, length), F.lit(_TERM))
        return F.transform(found, lambda s: F.struct(F.lower(s["value"]).alias("term"), (start + s["start"]).alias("at")))

    before, after = side(span["start"] - reach, reach), side(span["end"], F.lit(CONTEXT_CHARS))
    near = F.concat(F.slice(F.reverse(before), 1, CONTEXT_WORDS), F.slice(after, 1, CONTEXT_WORDS))
    return F.filter(near, lambda t: t["term"].rlike(r"\p{L}") & (F.length(t["term"]) > 1))


#: Up to so many terms (their number is measured) are broadcast; beyond, both sides are shuffled.
BROADCAST_TERMS = 200_000
#: Up to so many bytes of found terms are broadcast to the texts.
BROADCAST_FOUND = 64 << 20


def _checked(terms: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(terms) if rows <= BROADCAST_TERMS else terms


def disclosing_terms(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Terms that give an entity away: term, kind, disclosure (the strongest one).

    ``rows`` has the column text, ``spans`` an array column of (kind, value, context) per document.
    """
    each = spans.select(F.explode("spans").alias("span")).select("span.*")
    terms = F.array_distinct(F.transform("context", lambda t: t["term"]))
    contexts = (
        each.select("kind", "value", F.transform("context", lambda t: t["term"]).alias("words"), terms.alias("terms"))
        .groupBy("kind", "value", "words")
        .agg(F.first("terms").alias("terms"))
        .select("kind", "value", F.explode("terms").alias("term"))
        .groupBy("kind", "value", "term")
        .agg(F.count(F.lit(1)).alias("contexts"))
        .filter(F.col("contexts") >= MIN_CONTEXTS)
    )
    met = F.flatten(
        F.transform(
            "spans",
            lambda s: F.transform(
                s["context"],
                lambda t: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), t["term"].alias("term"), t["at"].alias("at")),
            ),
        )
    )
    together = (
        spans.select(F.explode(F.array_distinct(met)).alias("one"))
        .groupBy("one.kind", "one.value", "one.term")
        .agg(F.count(F.lit(1)).alias("together"))
    )
    pairs = store(contexts.join(together, ["kind", "value", "term"]), "pii-pairs")
    candidates = pairs.select("term").distinct()
    n_candidates = candidates.count()
    if not n_candidates:
        return pairs.select("term", "kind", F.lit(0.0).alias("disclosure"))
    counts = (
        rows.select(F.explode(terms_of(F.col("text"))).alias("term"))
        .join(_checked(candidates, n_candidates), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    given = (F.col("together") / F.col("occurrences")).alias("score")
    strongest = pairs.join(counts, "term").select("term", "kind", given).groupBy("term")
    found = strongest.agg(F.max(F.struct("score", "kind")).alias("best"))
    return found.select("term", "best.kind", F.col("best.score").alias("disclosure")).filter(
        F.col("disclosure") >= GENERALISE_AT
    )


def _term_spans(text: Column, found: Column, base: Column) -> Column:
    """Where the found terms stand in a text, outside base spans: like base spans, of the kind "term"."""
    quoted = F.array_join(F.transform(F.array_sort(found), lambda f: F.concat(F.lit(r"\Q"), f["term"], F.lit(r"\E"))), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), quoted, F.lit(r")(?![\p{L}\p{N}])"))
    outside = F.filter(
        _spans(text, pattern),
        lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])),
    )
    return F.transform(
        outside,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(len(KINDS)).alias("rank"),
            F.lit("term").alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            F.element_at(F.filter(found, lambda f: f["term"] == F.lower(s["value"])), 1)["instead"].alias("instead"),
        ),
    )


def find_spans(documents: DataFrame, *, identifier: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """One row per document with ``id``, ``key`` (of the text), ``base`` and ``terms`` spans; and the disclosing terms."""
    rows = documents.select(F.col(identifier).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = store(
        rows.select("id", "text", base_spans(F.col("text")).alias("base")).select(
            "id",
            F.xxhash64("text").alias("key"),
            "base",
            F.transform("base", lambda s: _context(F.col("text"), s)).alias("contexts"),
        ),
        "pii-base",
    )
    zipped = F.zip_with(
        "base", "contexts", lambda s, c: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), c.alias("context"))
    )
    spans = base.filter(F.size("base") > 0).select(zipped.alias("spans"))
    terms = store(disclosing_terms(rows, spans), "pii-terms")
    n_terms = terms.count()
    nothing = F.array().cast(f"array<{_SPAN}>")
    if not n_terms:
        return base.select("id", "key", "base", nothing.alias("terms")), terms

    instead = F.when(F.col("disclosure") >= REMOVE_AT, "").otherwise(F.concat(F.lit("<near "), "kind", F.lit(">")))
    keyed = rows.select("id", F.xxhash64("text").alias("key"), "text")
    owned = store(
        keyed.select("id", "key", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
        .join(_checked(terms.select("term", instead.alias("instead")), n_terms), "term")
        .groupBy("id", "key")
        .agg(F.collect_set(F.struct("term", "instead")).alias("found"))
        .withColumnsRenamed({"id": "own_id", "key": "own_key"}),
        "pii-owned",
    )
    # Texts stay where they are; only what was found in them moves, unless that is too much to broadcast.
    size = owned.agg(F.sum(F.length(F.to_json("found")) + 32)).first()[0] or 0
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    joined = keyed.join(F.broadcast(owned) if size <= BROADCAST_FOUND else owned, same, "left")
    spanned = joined.select("id", "key", "text", "found", base_spans(F.col("text")).alias("base"))
    placed = F.when(F.col("found").isNull(), nothing).otherwise(_term_spans(F.col("text"), F.col("found"), F.col("base")))
    return spanned.select("id", "key", "base", placed.alias("terms")), terms


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined by start, then kind."""
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced; where spans overlap, the first one counts."""

    def add(state: Column, span: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.when(
            span["start"] >= state["at"],
            F.struct(span["end"].alias("at"), F.concat(state["out"], kept, span["instead"]).alias("out")),
        ).otherwise(state)

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, rest)


def sanitise(documents: DataFrame, *, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with base spans replaced by their kind and disclosing terms removed or generalised."""
    found, _ = find_spans(documents, identifier=identifier, text=text)
    spans = F.concat("base", "terms")
    dirty = (
        found.select(F.col("id").alias("__id"), F.col("key").alias("__key"), spans.alias("__spans"))
        .filter(F.size("__spans") > 0)
        .dropDuplicates(["__id", "__key"])
    )
    same = F.col(identifier).eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__key"))
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(_replaced(F.col(text), F.col("__spans")))
    return documents.join(dirty, same, "left").withColumn(text, clean).select(*documents.columns)
