"""Personal data by bootstrapped contextual extraction (operator 2).

Seeds are the matches of four fixed patterns (email, ip, card, phone). What stands to the
left of a seed - its last word, or its last two - is a lexical pattern it induces.
Patterns and identifier-like words (words with a digit or an at sign) form a graph, an edge
for each occurrence. Rounds score it: a pattern by the share of its occurrences in
the corpus, whatever follows, that are followed by trusted instances; an instance by
the noisy-or of the confident patterns it occurs with; seeds stay at 1. A pattern needs
MIN_SEEDS different trusted instances. An instance found behind a confident pattern is trusted with its
score, and induces the patterns that it stands behind elsewhere, which find others in turn; the rounds
go on until no score grows. Words that follow a confident pattern are found as identifiers of the kind
that most of its trusted instances have.

All of it is DataFrame work: matches and their places come from splitting the text at the
pattern (places count code points), patterns are 64-bit hashes, corpus counts are
partial sums of the pattern table's own hashes only.

Group repetitions are possessive and starts are anchored to run starts. Both leave the
leftmost matches as they are, and keep long digit or letter runs from overflowing the
stack or taking quadratic time.

Defined results: null text is empty and has no spans; repeated rows and rows with null ids
are each searched; overlapping base matches of different kinds all count; a found word never
overlaps a base span, and has at least LEAST_CHARS characters without outer punctuation, since shorter
ones behind such a word (ages, counts, numbers of list items) name nobody; an empty table has no rows; very
long texts are searched whole; ties between kinds go to the kind named first; columns beyond those named are kept by ``redact`` and not read
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import text_of, written

# The kinds in order and their patterns. (?:(?<![c])|\G) anchors a match to
# the start of a run of c or to the end of the match before.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
REDACTED = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

# A word with a digit or an at sign, between white space.
IDENTIFIER = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
LEAST_CHARS = 6
MIN_SEEDS, CONFIDENT = 3, 0.6
# The rounds end when the scores of all patterns together grow by less.
SETTLED = 1e-3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.split(F.reverse(_digits(match)), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def accepted(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern is kept."""
    count = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(match)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _placed(pieces: Column, matches: Column) -> Column:
    """(start, end, text) of each match, from the pieces of the text between them."""
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def step(a, x):
        start = a["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("text"))
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

    gaps = F.slice(pieces, F.lit(1), F.size(matches))
    return F.aggregate(F.arrays_zip(gaps.alias("gap"), matches.alias("hit")),
                       F.struct(F.lit(0).alias("at"), none.alias("spans")), step,
                       lambda a: a["spans"])


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind the hits of its pattern; texts that cannot match are not searched."""
    has_digit, none = text.rlike("[0-9]"), F.array().cast("array<string>")
    made = {}
    for kind in KINDS:
        needed = has_digit if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
        if kind in ("ip", "phone"):
            needed = needed & has_digit
        made[kind] = F.when(needed, F.regexp_extract_all(
            text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none)
    return made


def with_base(rows: DataFrame) -> DataFrame:
    """Adds ``kinds`` to (.., text): accepted matches as (kind number, start, end, text)."""
    text, hits = F.col("text"), base_spans(F.col("text"))
    rows = rows.withColumns({f"hits_{k}": h for k, h in hits.items()})
    none = F.array().cast("array<struct<kind:int,start:int,end:int,text:string>>")

    def found(number: int, kind: str) -> Column:
        spans = F.filter(_placed(F.split(text, PATTERNS[kind]), F.col(f"hits_{kind}")),
                         lambda s: accepted(kind, s["text"]))
        return F.when(F.size(f"hits_{kind}") > 0, F.transform(spans, lambda s: F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["text"].alias("text")))).otherwise(none)

    return rows.withColumn("kinds", F.concat(*[found(n, k) for n, k in enumerate(KINDS)])).drop(*[f"hits_{k}" for k in KINDS])


# ---- patterns --------------------------------------------------------------------

# What stands for an identifier-like word, and for what precedes a text. Every word with
# a digit is identifier-like, so no other word can look like the first.
_MARK, _BEGIN = "0", "^"


def _words(text: Column) -> Column:
    """Two marks of the beginning and the lower-case words, identifiers as marks."""
    marked = F.when(text.rlike("[0-9@]"), F.regexp_replace(text, IDENTIFIER, _MARK)).otherwise(text)
    return F.concat(F.array(F.lit(_BEGIN), F.lit(_BEGIN)),
                    F.filter(F.split(F.lower(marked), r"\s+"), lambda w: w != ""))


def _patterns(words: Column, at: Column) -> Column:
    """Hashes of the one-word and the two-word pattern left of word ``at`` (from 0); null
    where the next word on the left is a mark."""
    one, two = F.get(words, at - 1), F.get(words, at - 2)
    word = ~one.isin(_MARK, _BEGIN)
    return F.array(F.when(word, F.xxhash64(F.lit(1), one)),
                   F.when(word, F.xxhash64(F.lit(2), two, one)))


def with_identifiers(rows: DataFrame) -> DataFrame:
    """Adds ``ids`` to (.., text, kinds): each identifier-like word, trimmed of punctuation,
    with its place, its patterns, and the kind and text of the base span that begins in it.
    Words inside a base span that begins before them are left out."""
    text = F.col("text")
    none = F.array().cast("array<string>")

    def described(word, i):
        inner = F.regexp_extract(word["text"], r"(?s)^[^A-Za-z0-9+]*+(.*?)[^A-Za-z0-9]*$", 1)
        start = word["start"] + F.instr(word["text"], inner) - 1
        over = F.filter("kinds", lambda s: (s["start"] < word["end"]) & (s["end"] > word["start"]))
        begun = F.get(F.filter(over, lambda s: s["start"] >= word["start"]), F.lit(0))
        return F.struct(
            start.alias("start"), (start + F.length(inner)).alias("end"),
            F.xxhash64(F.coalesce(begun["text"], inner)).alias("instance"),
            begun["kind"].alias("kind"), (F.size(over) > 0).alias("known"),
            _patterns(F.col("words"), F.get(F.col("places"), i)).alias("patterns"))

    any_hit = F.size("hits") > 0
    return (rows.withColumn("hits", F.when(text.rlike("[0-9@]"), F.regexp_extract_all(
                text, F.lit(IDENTIFIER), F.lit(0))).otherwise(none))
            .withColumn("words", F.when(any_hit, _words(text)))
            .withColumn("places", F.filter(
                F.transform("words", lambda w, i: F.when(w == _MARK, i)), lambda i: i.isNotNull()))
            .withColumn("hits", F.when(any_hit, _placed(F.split(text, IDENTIFIER), F.col("hits"))))
            .withColumn("ids", F.filter(
                F.transform("hits", described),
                lambda x: x["kind"].isNotNull()
                | (~x["known"] & (x["end"] - x["start"] >= LEAST_CHARS))))
            .drop("hits", "words", "places"))


def corpus_patterns(rows: DataFrame) -> DataFrame:
    """(pattern) of every place in all texts that a word follows."""
    return (rows.select(_words(F.col("text")).alias("words"))
            .select(F.explode(F.flatten(F.transform(
                F.filter(F.sequence(F.lit(1), F.size("words") - 1), lambda i: i > 1),
                lambda i: _patterns(F.col("words"), i)))).alias("pattern"))
            .filter("pattern IS NOT NULL"))


def bootstrapped(seen: DataFrame, rows: DataFrame, rounds: int | None, min_seeds: int, confident: float
                 ) -> DataFrame | None:
    """(pattern, kind, confidence) of the confident patterns when no score grows any more, or after
    ``rounds``; None if there is none. ``seen``: pattern, instance, kind (null but for seeds)."""
    edges = written(seen.groupBy("pattern", "instance").agg(
        F.min("kind").alias("kind"), F.count(F.lit(1)).alias("n")), "pii-edges")
    seeds = written(edges.filter("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind")), "pii-seeds")
    trusted, totals, scores, last = seeds.withColumn("s", F.lit(1.0)), None, None, (0, 0.0)
    edges = edges.drop("kind")
    while rounds is None or rounds > 0:
        rounds = None if rounds is None else rounds - 1
        # patterns that enough different instances induce, with the kind of most of them
        induced = written(
            edges.join(trusted, "instance").groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("s") * F.col("n")).alias("held"))
            .groupBy("pattern").agg(F.sum("k").alias("k"), F.sum("held").alias("held"),
                                    F.max(F.struct("k", (-F.col("kind")).alias("first"))).alias("top"))
            .filter(F.col("k") >= min_seeds)
            .select("pattern", "held", (-F.col("top.first")).alias("kind")), "pii-patterns")
        new = induced.select("pattern")
        if totals is not None:
            new = written(new.join(totals, "pattern", "left_anti"), "pii-new")
        if totals is None or not new.isEmpty():
            counted = written(corpus_patterns(rows).join(new, "pattern", "left_semi")
                              .groupBy("pattern").agg(F.count(F.lit(1)).alias("total")), "pii-totals")
            totals = counted if totals is None else totals.unionByName(counted)
        scores = written(
            induced.join(totals, "pattern")
            .select("pattern", "kind", F.least(F.lit(1.0), F.col("held") / F.col("total")).alias("confidence"))
            .filter(F.col("confidence") >= confident), "pii-scores")
        now = scores.agg(F.count(F.lit(1)), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if not now[0]:
            return None
        if now[0] == last[0] and now[1] - last[1] < SETTLED:
            break
        last = now
        found = (edges.join(scores, "pattern").groupBy("instance")
                 .agg((1 - F.product(1 - F.col("confidence"))).alias("s"),
                      F.max(F.struct("confidence", (-F.col("kind")).alias("first"))).alias("top"))
                 .select("instance", (-F.col("top.first")).alias("kind"), "s")
                 .join(seeds, "instance", "left_anti"))
        trusted = written(seeds.withColumn("s", F.lit(1.0)).unionByName(found), "pii-trusted")
    return scores


# ---- operator --------------------------------------------------------------------


def find(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         rounds: int | None = None, min_seeds: int = MIN_SEEDS, confident: float = CONFIDENT
         ) -> DataFrame:
    """The columns of ``keep``, ``base`` and ``spans``: arrays of (kind number, start, end),
    the base matches alone and with the found words, in order of kind and start."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep"),
                       text_of(text_col).alias("text"))
    searched = written(
        with_identifiers(with_base(rows))
        .select(F.monotonically_increasing_id().alias("row"), "keep",
                F.transform("kinds", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias(
                    "start"), s["end"].alias("end"))).alias("base"), "ids"), "pii-spans")
    seen = (searched.select("row", F.explode("ids").alias("x"))
            .select("row", "x.start", "x.end", "x.instance", "x.kind",
                    F.explode("x.patterns").alias("pattern")).filter("pattern IS NOT NULL"))
    trusted = bootstrapped(seen, rows, rounds, min_seeds, confident)
    if trusted is None:
        return searched.select("keep.*", F.array_sort("base").alias("base"), F.array_sort("base").alias("spans"))
    added = written(
        seen.filter("kind IS NULL").drop("kind").join(trusted, "pattern")
        .groupBy("row", "start", "end")
        .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("first"))).alias("top"))
        .groupBy("row").agg(F.collect_list(F.struct(
            (-F.col("top.first")).alias("kind"), "start", "end")).alias("added")), "pii-added")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return (searched.join(added, "row", "left")
            .select("keep.*", F.array_sort("base").alias("base"),
                    F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind's mark; spans that overlap become one."""
    marks = F.array(*[F.lit(REDACTED[k]) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(a, s):
        fresh = s["start"] >= a["at"]
        between = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(a["made"], between, F.element_at(marks, s["kind"] + 1)))
            .otherwise(a["made"]).alias("made"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, start, step,
        lambda a: F.concat(a["made"], F.substr(text, a["at"] + 1))))


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with base and found spans replaced in the text; null texts stay null."""
    # the text is not among the packed columns: it would be written twice
    others = [c for c in docs.columns if c != text_col]
    doc = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc")] if others else []
    packed = docs.select(*doc, F.col(f"`{text_col}`").alias("text"))
    found = find(packed, "text", keep=tuple(packed.columns), **options)
    made = F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col("spans")))
    return found.select(*[made.alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
                          for c in docs.columns])
