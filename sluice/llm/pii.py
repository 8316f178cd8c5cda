"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover.

All of it is DataFrame functions.  The fixed patterns give the base spans of
each text.  Every base span, every token with a digit or an at sign and every
group of numbers is an instance; the word before it, the word after it, both, and
the word before with the instance's shape are its patterns; base spans are the
seeds.  Rounds of scoring pass over the pattern-instance graph: a pattern is as
good as the instances it extracts, an instance that is no seed as good for a
pattern as the best other pattern that extracts it.  Patterns with enough seeds,
a high share of them and a high score then give spans of their own, if their
words stand beside instances in most of all their occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, texts

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns.  Look-behinds and possessive repeats only keep the matcher
# linear and off the stack; they match what the plain forms match.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no span of the kind.
_SIGNS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}

#: Different seeds a pattern must extract, the score it must reach, and the rounds of scoring.
SEEDS, SCORE, ROUNDS = 5, 0.8, 3
#: Seeds among the different tokens that a pattern extracts, at least; no support makes up for them.
SHARE = 0.75
#: Share of all occurrences of a pattern's word that stand beside an instance, at least: a word of plain prose marks nothing.
RATE = 0.5
#: Shortest token that can be discovered.
SHORTEST = 6
_SPANS = "array<struct<start:int,end:int,kind:string>>"
#: Stands for the characters of base spans while instances are located.
_MARK = "\ue000"
_NUMBER = rf"[+(]*+[0-9]++(?:[().-]++[0-9]++)*+\)?+(?=[^\p{{L}}0-9@\s{_MARK}]*+(?:\s|$))"
#: A word and blanks, so that one pass finds it too, then what holds a base span, numbers in groups (19 at most, as the
#: digits of a card), or a token with a digit or an at sign; further base spans of the same token.  The look-ahead lets
#: words that neither hold nor precede any of that fail at once.
_WIDE = (rf"(?<!\S)(?=[^\s0-9@{_MARK}]*+(?:\s++[^\s0-9@{_MARK}]*+)?+[0-9@{_MARK}])"
         rf"(?:[^\s0-9@{_MARK}]++\s++)?(?:[^\s{_MARK}]*+{_MARK}++|{_NUMBER}(?:\x20{_NUMBER}){{1,18}}+|[^\s0-9@{_MARK}]*+[0-9@]\S*+)"
         rf"|(?<={_MARK})[^\s{_MARK}]*+{_MARK}++")


def _located(text: Column, pattern: str) -> Column:
    """Matches with their code-point offsets."""
    return _placed(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1))


def _placed(found: Column, gaps: Column) -> Column:
    """The pieces between the matches, one more than there are matches, say where they lie."""
    step = F.zip_with(found, gaps, lambda m, g: F.struct(F.length(g).alias("g"), m.alias("m")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out"))
    return F.aggregate(step, empty, lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(F.struct(
        (acc["at"] + x["g"] + F.length(x["m"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("start"),
                 (acc["at"] + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("m")))).alias("out"))))["out"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, F.coalesce(d.try_cast("int"), F.lit(0)) * 2).otherwise(F.coalesce(d.try_cast("int"), F.lit(0))))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        # at most three digits once leading zeros are gone, so the cast cannot overflow
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, end, kind) by start, then by kind as listed."""
    def of(kind):
        hits = F.filter(_located(text, _PATTERNS[kind]), lambda x: _valid(kind, x["m"]))
        rows = F.transform(hits, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))
        return F.when(text.rlike(_SIGNS[kind]), rows).otherwise(F.array().cast(_SPANS))

    return ordered(F.concat(*[of(k) for k in KINDS]))


def ordered(spans: Column) -> Column:
    rank = lambda k: F.coalesce(F.array_position(F.array(*[F.lit(x) for x in KINDS]), k), F.lit(0))
    last = len(KINDS) + 1
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), F.when(rank(s["kind"]) == 0, last).otherwise(rank(s["kind"])).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(order), lambda x: x["s"])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _shape(token: Column) -> Column:
    """Letters and digits by class, runs as one: ``a9@a9.a`` for an address."""
    out = token
    for pattern, to in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"[0-9]+", "9")):
        out = F.regexp_replace(out, pattern, to)
    return out


def _masked(text: Column, base: Column) -> Column:
    """The text with each base span filled with marks, of the same length."""
    def filled(plain):
        def one(acc, x):
            return F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(x["end"].alias("at"), F.concat(
                acc["out"], F.substring(plain, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0))),
                F.repeat(F.lit(_MARK), x["end"] - F.greatest(x["start"], acc["at"]))).alias("out")))

        cut = F.aggregate(base, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), one)
        rest = lambda c: F.concat(c["out"], F.substring(plain, c["at"] + 1, F.length(plain)))
        return F.get(F.transform(F.array(cut), rest), F.lit(0))

    # names for the text and for the part in front of the rest, or each span would make them again
    plain = F.translate(text, _MARK, " ")
    return F.when(F.size(base) == 0, plain).otherwise(F.get(F.transform(F.array(plain), filled), F.lit(0)))


def _word(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, r"^[^\p{L}]+|[^\p{L}]+$", ""))


def located_tokens(docs: DataFrame) -> DataFrame:
    """Per row: id, a number of the text, base spans, and the instances (token, offsets, seed, patterns).

    A base span is one instance, whatever blanks it has; so is a run of numbers with single blanks between them.
    """
    text = F.coalesce("text", F.lit(""))
    d = texts(docs).select("doc_id", text.alias("text"), F.xxhash64(text).alias("body"), base_spans(text).alias("base"))
    d = d.withColumn("masked", _masked(F.col("text"), F.col("base")))
    # texts without a sign of an instance are not searched; the columns are read several times, so each is made once
    signed = F.col("masked").rlike(f"[0-9@{_MARK}]")
    d = d.withColumns({
        "found": F.when(signed, F.regexp_extract_all("masked", F.lit(_WIDE), F.lit(0))).otherwise(F.array().cast("array<string>")),
        "pieces": F.when(signed, F.split("masked", _WIDE, -1)).otherwise(F.array(F.col("masked")))})
    # what follows each: the piece up to the next one, and the word that the next one begins with
    hits = F.transform(_placed(F.col("found"), F.col("pieces")), lambda x, i: F.struct(
        *[x[c].alias(c) for c in ("start", "end", "m")],
        F.concat(F.get("pieces", i + 1), F.coalesce(F.get("found", i + 1), F.lit(""))).alias("after")))

    def edge(word, at_edge):
        """A side without a word: the edge of the text, or something else that is no word."""
        return F.when(F.length(word) > 0, word).when(at_edge, F.lit("^")).otherwise(F.lit("#"))

    def some(word, kind, *of):
        return F.when(F.length(word) > 0, F.concat_ws(" ", F.lit(kind), *of))

    def unit(x):
        return x.withField("unit", F.regexp_replace(x["m"], rf"^[^\s0-9@{_MARK}]++\s++", "")).withField("seed", x["m"].contains(_MARK))

    def bare(x):
        plain = F.regexp_replace(x["unit"], r"[^\p{L}0-9]+$", "")
        return (x.withField("label", F.regexp_extract(x["unit"], rf"^([^{_MARK}]*+){_MARK}", 1))
                .withField("bare", F.when(x["seed"], F.regexp_extract(x["unit"], f"({_MARK}+)", 1)).otherwise(plain)))

    def place(x):
        start = x["end"] - F.length(x["unit"]) + F.length(x["label"])
        return x.withField("at", start).withField("to", start + F.length(x["bare"])).withField("own", _word(x["label"]))

    def sides(x):
        token = F.when(x["seed"], F.substring(F.col("text"), x["at"] + 1, F.length(x["bare"]))).otherwise(x["bare"])
        before = _word(F.regexp_extract(x["m"], rf"^([^\s0-9@{_MARK}]++)\s", 1))
        right = _word(F.regexp_extract(x["after"], rf"^[^\p{{L}}0-9@{_MARK}]*+(\p{{L}}[^\s0-9@{_MARK}]*+)(?=\s|$)", 1))
        return (x.withField("token", token).withField("left", F.when(F.length(x["own"]) > 0, x["own"]).otherwise(before))
                .withField("right", right))

    def instance(x):
        left, right = x["left"], x["right"]
        both = F.concat_ws(" ", edge(left, x["start"] == 0), edge(right, F.trim(x["after"]) == ""))
        patterns = F.array_compact(F.array(some(left, "L", left), some(right, "R", right), some(F.concat(left, right), "B", both),
                                           some(left, "S", left, _shape(x["token"]))))
        return F.struct(x["token"].alias("token"), x["at"].alias("start"), x["to"].alias("end"), x["seed"].alias("seed"),
                        patterns.alias("patterns"))

    # one step after the other: what a later one reads several times is made once
    for step in (unit, bare, place, sides, instance):
        hits = F.transform(hits, step)
    return d.select("doc_id", "body", "base", hits.alias("hits"))


def scored(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, seeds, n, score) from distinct edges (pattern, token, seed).

    A seed is worth 1, another token what the best OTHER pattern that extracts it scored in the round before, damped.
    """
    stats = stored(edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("long")).alias("seeds"), F.count(F.lit(1)).alias("n")), "patterns")
    own = (F.col("seeds") + F.coalesce("support", F.lit(0.0))) / (F.col("n") + 1)
    scores = stats.select("*", (F.col("seeds") / (F.col("n") + 1)).alias("score"))
    # only a token that is no seed and that several patterns extract can be supported
    several = edges.groupBy("token").agg(F.count(F.lit(1)).alias("in"), F.min("seed").alias("all")).where((F.col("in") > 1) & ~F.col("all"))
    shared = stored(edges.join(several.select("token"), "token", "left_semi"), "shared")
    for _ in range(rounds):
        votes = stored(shared.join(scores.select("pattern", "score"), "pattern"), "votes")
        best = votes.groupBy("token").agg(F.max(F.struct("score", "pattern")).alias("best"))
        votes = votes.join(best, "token")
        first = F.col("best.pattern") == F.col("pattern")
        second = votes.where(~first).groupBy("token").agg(F.max("score").alias("second"))
        worth = F.when(first, F.col("second")).otherwise(F.col("best.score"))
        support = votes.where(~F.col("seed")).join(second, "token").groupBy("pattern").agg((0.9 * F.sum(worth)).alias("support"))
        scores = stored(stats.join(support, "pattern", "left").select(*stats.columns, own.alias("score")), "scores")
    return scores


def _words_of(pattern: Column) -> Column:
    """The words of a pattern: its left one, its right one, or both; not the edges, not a shape."""
    part = F.split(pattern, " ")
    words = F.when(part[0] == "B", F.slice(part, 2, 2)).otherwise(F.slice(part, 2, 1))
    return F.array_distinct(F.filter(words, lambda w: ~w.isin("^", "#")))


def marking(good: DataFrame, uses: DataFrame, docs: DataFrame, rate: float) -> DataFrame:
    """The patterns of ``good`` whose words stand beside an instance in ``rate`` of all their occurrences at least.

    ``uses`` has each pattern's number of instances.  Of a pattern with two words the rarer one counts.
    """
    wanted = good.select("pattern", F.explode(_words_of(F.col("pattern"))).alias("word"))
    words = stored(wanted.select("word").distinct(), "words")
    every = docs.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\s+")).alias("word"))
    every = every.select(_word(F.col("word")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    least = wanted.join(every.join(words, "word"), "word").groupBy("pattern").agg(F.min("times").alias("times"))
    return least.join(uses, "pattern").where(F.col("uses") >= rate * F.col("times")).select("pattern")


def discover(found: DataFrame, docs: DataFrame, seeds: int = SEEDS, score: float = SCORE, rounds: int = ROUNDS, share: float = SHARE,
             rate: float = RATE) -> DataFrame:
    """(doc_id, body, start, end) of tokens that good patterns extract beyond the base spans."""
    every = found.select("doc_id", "body", F.explode("hits").alias("h")).select("doc_id", "body", "h.*").withColumn("pattern", F.explode("patterns"))
    one = every.where(F.col("seed") | (F.length("token") >= SHORTEST))
    # an occurrence has one pattern of each kind; support comes from patterns of the same kind, so from other places
    token = F.concat(F.substring("pattern", 1, 1), "token").alias("token")
    edges = stored(one.groupBy("pattern", token).agg(F.max("seed").alias("seed")), "edges")
    good = stored(scored(edges, rounds).where((F.col("seeds") >= seeds) & (F.col("seeds") >= share * F.col("n")) & (F.col("score") >= score))
                  .select("pattern"), "good")
    uses = every.join(good, "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("uses"))
    good = stored(marking(good, uses, docs, rate), "marking")
    return one.where("not seed").join(good, "pattern", "left_semi").select("doc_id", "body", "start", "end").distinct()


def spans(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, body, base, spans) per document row; ``body`` is the hash of the text.

    Null and empty texts have no spans; rows that repeat have the same spans;
    a row without an id is found by its text.  Discovered spans are of kind
    ``context`` and never overlap base spans.
    """
    found = stored(located_tokens(docs), "located")
    extra = discover(found, docs, **how).groupBy("doc_id", "body").agg(
        F.collect_set(F.struct(F.col("start"), F.col("end"), F.lit("context").alias("kind"))).alias("extra"))
    x = extra.select(F.col("doc_id").alias("x_id"), F.col("body").alias("x_body"), "extra")
    both = found.select("doc_id", "body", "base").join(x, (F.col("doc_id").eqNullSafe(F.col("x_id"))) & (F.col("body") == F.col("x_body")), "left")
    return both.select("doc_id", "body", "base", ordered(F.concat("base", F.coalesce("extra", F.array().cast(_SPANS)))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    s = spans(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return s.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                    joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, **how) -> DataFrame:
    """The documents (all columns) with every span replaced by its kind in brackets; null texts stay null.

    Only the texts that have spans are joined with them; n_chars, where there is such a column, follows the text.
    """
    s = spans(docs, **how).where(F.size("spans") > 0).select("doc_id", "body", "spans").distinct()
    # the user's row is one column, so its names meet no others
    d = docs.select(F.struct(*docs.columns).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("own_id"), F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("own_text"))
    d = d.withColumn("own_body", F.xxhash64("own_text"))
    both = d.join(s, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_body") == F.col("body")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    # overlapping spans: what an earlier one covers is not repeated
    cut = F.aggregate("spans", start, lambda acc, x: F.when(x["start"] < acc["at"], F.struct(
        F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
            x["end"].alias("at"), F.concat(acc["out"], F.substring(F.col("own_text"), acc["at"] + 1, x["start"] - acc["at"]),
                                           F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("out"))))
    changed = F.col("spans").isNotNull()
    both = both.withColumn("new_text", F.when(changed, F.concat(cut["out"], F.substring(F.col("own_text"), cut["at"] + 1, F.length("own_text")))))
    given = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return both.select(*[(F.when(changed, given[c]).otherwise(F.col(f"row.`{c}`")) if c in given else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns])
