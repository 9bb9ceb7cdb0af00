"""Operator 10: personal data by bootstrapped contextual extraction (DataFrame operations only).

Base patterns find the seed entities: e-mail addresses, IP addresses, card numbers, phone numbers.  The words
beside them are lexical patterns, each for a kind: ``<word`` (the word before) and ``>word`` (the word after).
The unseen instances are what no base span touches of

* the slots of the patterns: the text between a word before and the next word after of the same kind, on one line, with
  ``SLOT_WORDS`` words at most, whatever its shape (spaces and brackets included).  The patterns of slots have ``SEEDS``
  distinct seeds, and their word stands beside a seed at ``RELIABLE`` of its places in all texts;
* identifier-like tokens (six digits or more), which need a pattern on one side only.

Patterns and instances form a bipartite graph that Spark scores in turns: a pattern's confidence for a kind is the mean score
of its instances, lowered by ``PRIOR`` virtual instances of score 0; an instance's score is the noisy-or of its
patterns' confidences, seeds stay at 1 for their kind and 0 for others.  After ``ROUNDS`` turns the unseen
instances that score ``ACCEPT`` or more and are backed by a pattern with ``SEEDS`` distinct seeds are spans of
that kind wherever they were candidates; kinds made of digits ask for ``TOKEN_DIGITS`` digits, and a span inside a longer
accepted one goes.

Places are code points, end exclusive.  Matches are leftmost and do not overlap; the expressions below find the
same matches as the plain patterns but never scan a run of characters twice: a match begins at the end of the one
before (``\\G``) or where its run begins, and repetitions that need no backtracking are possessive.

Distribution: what is kept of texts are spans and their two neighbouring words.  Words of all texts are counted with
map-side sums, so a frequent word is one partial row a task; texts are read once more for the places of the patterns'
words, and only texts with slots are cut at them.  Slots are found by a window over one text's places.

Defined cases: a null text is an empty text; a null doc_id is kept; rows that share doc_id and text get the same
spans; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosband.llm.common import let, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Identifier-like tokens: a digit after four letters at most, then letters, digits and inner marks.
TOKEN = r"(?:\G|(?<![A-Za-z0-9]))[A-Za-z]{0,4}[0-9][A-Za-z0-9]*+(?:[-._/][A-Za-z0-9]++)*+"
TOKEN_DIGITS = 6

ROUNDS = 3
PRIOR = 2.0
SEEDS = 3
ACCEPT = 0.9
SLOT_WORDS = 10
RELIABLE = 0.2
NOT_WORD = r"[^\p{L}\p{N}]+"
_CHUNK = 256


def running_total(values: Column) -> Column:
    """Sum of the values before each place of an integer array, in chunks (time in proportion to the length)."""
    zero = F.lit(0).cast("int")
    add = lambda a, v: a + v

    def within(v: Column) -> Column:
        chunks = F.ceil(F.size(v) / _CHUNK).cast("int")
        tops = F.aggregate(
            F.sequence(zero, chunks - 1),
            F.array(zero),
            lambda acc, b: F.concat(
                acc, F.array(F.element_at(acc, -1) + F.aggregate(F.slice(v, b * _CHUNK + 1, F.lit(_CHUNK)), zero, add))
            ),
        )
        place = lambda i: F.pmod(i, F.lit(_CHUNK))
        return let(
            tops,
            lambda t: F.transform(
                v,
                lambda x, i: F.element_at(t, (i / _CHUNK).cast("int") + 1)
                + F.aggregate(F.slice(v, i - place(i) + 1, place(i)), zero, add),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(within(v)))


def _word(beside: Column, pattern: str) -> Column:
    """The neighbouring word in lower case without outer punctuation; empty at a text's or line's end."""
    return F.lower(F.regexp_extract(beside, pattern, 1))


def found(text: Column, pattern: str, clue: Column) -> Column:
    """``array<struct<start, end, value, before, after>>`` of the matches of ``pattern``; texts without ``clue`` have none."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start: int, end: int, value: string, before: string, after: string>>")

    def spans(x: Column) -> Column:
        g, h = x["gaps"], x["hits"]
        sizes = F.transform(h, lambda hit, i: F.length(F.element_at(g, i + 1)) + F.length(hit))

        def at(total: Column) -> Column:
            def span(hit: Column, i: Column) -> Column:
                start = F.element_at(total, i + 1) + F.length(F.element_at(g, i + 1))
                left, right = F.element_at(g, i + 1), F.element_at(g, i + 2)
                return F.struct(
                    start.alias("start"),
                    (start + F.length(hit)).alias("end"),
                    hit.alias("value"),
                    _word(left, r"(?<![\p{L}\p{N}])([\p{L}\p{N}]++)[^\p{L}\p{N}\n]*+$").alias("before"),
                    _word(right, r"^[^\p{L}\p{N}\n]*+([\p{L}\p{N}]++)").alias("after"),
                )

            return F.transform(h, span)

        return let(running_total(sizes), at)

    return F.when(clue, let(F.struct(gaps.alias("gaps"), hits.alias("hits")), spans)).otherwise(empty)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(F.pmod(i, F.lit(2)) == 1, double(F.try_to_number(d, F.lit("9")).cast("int"))).otherwise(
            F.try_to_number(d, F.lit("9")).cast("int")
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """What a match must hold beside its pattern."""
    digits = digits_of(value)
    if kind == "ip":
        part = lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))
        return F.forall(F.split(value, r"\."), part)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _valid_span(kind: str):
    return lambda x: valid(kind, x["value"])


def _of_kind(kind: str, *fields: str):
    """A span with its kind first."""
    return lambda x: F.struct(F.lit(kind).alias("kind"), *[x[f].alias(f) for f in fields])


def entities(docs: DataFrame) -> DataFrame:
    """Per row: key columns, one array of base spans per kind and ``tokens``, the unseen identifier-like tokens."""
    text = text_or_empty()
    digit = text.rlike("[0-9]")
    clues = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+")) & digit}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), *[
        F.filter(found(text, patterns[k], clues[k]), _valid_span(k)).alias(k) for k in KINDS
    ], F.filter(
        found(text, TOKEN, digit), lambda x: F.length(digits_of(x["value"])) >= TOKEN_DIGITS
    ).alias("tokens"))
    return rows


def occurrences(rows: DataFrame) -> DataFrame:
    """One row per span: key columns, ``kind`` (null for unseen tokens), place, ``instance`` and the words beside it."""
    base = F.concat(*[
        F.transform(k, _of_kind(k, "start", "end", "value", "before", "after")) for k in KINDS
    ])
    spans = rows.where(F.size(F.concat(*[F.col(k) for k in KINDS])) + F.size("tokens") > 0)
    spans = spans.withColumn("base", base)
    seeds = spans.select("doc_id", "text_hash", F.inline("base"))
    free = spans.select("doc_id", "text_hash", "base", F.inline("tokens")).where(
        ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    )
    free = free.select("doc_id", "text_hash", F.lit(None).cast("string").alias("kind"), "start", "end", "value", "before", "after")
    both = seeds.unionAll(free).withColumn("instance", F.lower("value"))
    return both.drop("value")


def reliable_words(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``word, side, kind`` of the patterns whose slots are read: enough distinct seeds, beside seeds often enough."""
    sides = F.inline(F.array(F.struct(F.col("before").alias("word"), F.lit("<").alias("side")),
                             F.struct(F.col("after").alias("word"), F.lit(">").alias("side"))))
    seeds = spans.where("kind is not null").select("doc_id", "text_hash", "start", "kind", "instance", sides).where("word != ''")
    hits = seeds.groupBy("word", "side", "kind", "instance").agg(F.count("*").alias("n"))
    hits = hits.groupBy("word", "side", "kind").agg(F.count("*").alias("seeds"), F.sum("n").alias("n"))
    every = docs.select(F.explode(F.split(text_or_empty(), NOT_WORD)).alias("word")).where("word != ''")
    total = every.groupBy("word").agg(F.count("*").alias("n")).groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("total"))
    strong = written(hits.where(F.col("seeds") >= SEEDS))
    return strong.join(total, "word").where(F.col("n") >= RELIABLE * F.col("total")).select("word", "side", "kind")


def slots(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``doc_id, text_hash, i, j``: the word places before and after every slot of the reliable words."""
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash")]
    places = docs.select(*key, F.posexplode(F.split(text_or_empty(), NOT_WORD, -1)).alias("i", "word"))
    places = places.withColumn("word", F.lower("word")).where("word != ''").join(words, "word")
    places = places.select("doc_id", "text_hash", "kind", "side", "i").distinct()
    later = Window.partitionBy("doc_id", "text_hash", "kind").orderBy(-F.col("i")).rangeBetween(Window.unboundedPreceding, -1)
    follows = F.min(F.when(F.col("side") == ">", F.col("i"))).over(later)
    found_slots = places.withColumn("j", follows).where("side = '<'")
    return found_slots.where((F.col("j") - F.col("i")).between(2, SLOT_WORDS + 1)).select("doc_id", "text_hash", "i", "j").distinct()


def fillers(docs: DataFrame, found_slots: DataFrame) -> DataFrame:
    """What stands in the slots: the rows of ``occurrences`` without a kind.  Outer blanks and stops are no part of it."""
    per_text = found_slots.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("i", "j")).alias("slots"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text")
    )
    same = texts["doc_id"].eqNullSafe(per_text["doc_id"]) & (texts["text_hash"] == per_text["text_hash"])
    cut = texts.join(per_text, same).select(
        texts["doc_id"], texts["text_hash"], "slots", F.split("text", NOT_WORD, -1).alias("w"),
        F.regexp_extract_all("text", F.lit(NOT_WORD), F.lit(0)).alias("s"),
    )
    sizes = F.transform("w", lambda w, k: F.length(w) + F.coalesce(F.length(F.get("s", k)), F.lit(0)))
    cut = cut.withColumn("at", running_total(sizes))

    def filler(x: Column) -> Column:
        i, j = x["i"], x["j"]
        gaps = F.slice("s", i + 2, j - i - 1)  # behind each word of the slot
        inner = F.zip_with(F.slice("w", i + 2, j - i - 1), gaps, lambda w, g: F.concat(w, g))
        return F.struct(
            (F.element_at("at", i + 1) + F.length(F.element_at("w", i + 1))).alias("start"),
            F.concat(F.element_at("s", i + 1), F.array_join(inner, "")).alias("value"),
            F.lower(F.element_at("w", i + 1)).alias("before"),
            F.lower(F.element_at("w", j + 1)).alias("after"),
        )

    out = cut.select("doc_id", "text_hash", F.inline(F.transform("slots", filler))).where(~F.contains("value", F.lit("\n")))
    lead = F.length(F.regexp_extract("value", r"^[\s,;:=#|\"']*+", 0))
    value = F.regexp_replace("value", r"^[\s,;:=#|\"']++|(?<![\s,;:=#|\"'.!?])[\s,;:=#|\"'.!?]++$", "")
    out = out.withColumn("start", F.col("start") + lead).withColumn("value", value)
    end = (F.col("start") + F.length("value")).alias("end")
    kind = F.lit(None).cast("string").alias("kind")
    return out.select("doc_id", "text_hash", kind, "start", end, "before", "after", F.lower("value").alias("instance"))


def untouched(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans that no base span of their text touches."""
    base = F.concat(*[F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for k in KINDS])
    of_text = rows.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), base.alias("base")).dropDuplicates(["d", "h"])
    near = spans.join(of_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    return near.where(free).select(*spans.columns)


def score(spans: DataFrame, rounds: int = ROUNDS, prior: float = PRIOR) -> DataFrame:
    """``instance, kind, score, backing``: unseen instances by kind; ``backing`` is the most distinct seeds of a pattern."""
    words = F.array(F.concat(F.lit("<"), "before"), F.concat(F.lit(">"), "after"))
    edges = spans.select(F.explode(words).alias("pattern"), "instance", "kind").where(F.length("pattern") > 1).distinct()
    seed = F.max(F.col("kind").isNotNull()).alias("is_seed")
    edges = written(edges)
    known = edges.groupBy("pattern", "instance").agg(seed)
    pairs = known.join(edges.where("kind is not null").select("pattern", "kind").distinct(), "pattern")
    pairs = pairs.join(edges.withColumn("own", F.lit(1.0)), ["pattern", "instance", "kind"], "left")
    # a row for each pattern, instance and kind that the pattern has seeds of
    pairs = written(pairs.select("pattern", "kind", "instance", "is_seed", F.coalesce("own", F.lit(0.0)).alias("score")))
    graph = pairs
    for _ in range(rounds):
        pattern = graph.groupBy("pattern", "kind").agg(
            (F.sum("score") / (F.count("*") + prior)).alias("confidence"),
            F.sum(F.col("is_seed").cast("long") * (F.col("score") == 1).cast("long")).alias("seeds"),
        )
        rated = graph.join(pattern, ["pattern", "kind"])
        instance = rated.where("not is_seed").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("found"), F.max("seeds").alias("backing")
        )
        instance = written(instance)
        graph = (
            pairs.join(instance.drop("backing"), ["instance", "kind"], "left")
            .withColumn("score", F.when(F.col("is_seed"), F.col("score")).otherwise(F.coalesce("found", F.lit(0.0))))
            .drop("found")
        )
    return instance.withColumnRenamed("found", "score")


def candidates(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Seeds and unseen instances with the words beside them, one row per place."""
    spans = written(occurrences(rows))
    found_slots = written(slots(docs, written(reliable_words(docs, spans))))
    filled = untouched(rows, fillers(docs, found_slots))
    return spans.unionByName(filled).distinct()


def discovered(docs: DataFrame, rows: DataFrame, accept: float = ACCEPT, seeds: int = SEEDS) -> DataFrame:
    """``doc_id, text_hash, spans``: the accepted spans of unseen instances, as ``array<struct<kind, start, end>>``."""
    spans = written(candidates(docs, rows))
    rated = score(spans).where((F.col("score") >= accept) & (F.col("backing") >= seeds))
    rated = rated.where((F.col("kind") == "email") | (F.length(digits_of(F.col("instance"))) >= TOKEN_DIGITS))
    best = rated.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best"))
    best = best.select("instance", F.col("best.kind").alias("kind"))
    free = spans.where("kind is null").drop("kind").join(best, "instance")
    more = free.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))
    longer = lambda x, y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]) & (y["end"] - y["start"] > x["end"] - x["start"])
    return more.withColumn("more", F.filter("more", lambda x: ~F.exists("more", lambda y: longer(x, y))))


def listed(spans: dict[str, Column]) -> Column:
    """``kind:start:end`` by kind as listed, then by start, joined by commas."""
    parts = [
        F.transform(
            F.transform(F.array_sort(a), _of_kind(k, "start", "end")),
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        )
        for k, a in spans.items()
    ]
    return F.array_join(F.concat(*parts), ",")


def extract(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base spans by kind and ``more`` (discovered spans with their kind) of every row of ``docs``."""
    rows = written(entities(docs))
    more = discovered(docs, rows)
    same = rows["doc_id"].eqNullSafe(more["doc_id"]) & (rows["text_hash"] == more["text_hash"])
    out = rows.join(more, same, "left")
    place = lambda k: F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(k)
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    return out.select(rows["doc_id"], *[place(k) for k in KINDS], F.coalesce("more", none).alias("more"))


def digest(docs: DataFrame) -> DataFrame:
    out = extract(docs)
    of_kind = lambda k: F.transform(
        F.filter("more", lambda x: x["kind"] == k), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    )
    return out.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed({k: F.col(k) for k in KINDS}), 256).alias("base_sha256"),
        listed({k: F.concat(F.col(k), of_kind(k)) for k in KINDS}).alias("spans"),
        F.size("more").cast("long").alias("n_found"),
    )
