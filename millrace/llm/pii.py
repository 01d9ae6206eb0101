"""Personal data and secrets in texts, by rules and by weakly supervised labelling.

Rules give e-mail addresses, network addresses, card numbers and telephone numbers.
Other candidates are long words with digits in them; labelling functions vote on each
(patterns, a gazetteer, its context, its shape). Expectation-maximisation over the
counts of vote patterns estimates how reliable each is, and the estimates train a
classifier over the candidates' features, which decides what is reported as a secret.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

# The kinds' patterns. Possessive repeats and look-behinds keep the
# matches of the plain patterns but never try a run of letters or digits again.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Of runs of digits only those with 16 digits and more can be cards.
CARD = r"[0-9](?:[\x20-]?+[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "secret")

#: A candidate: a run of at least this many of these characters, with a digit.
CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+"
#: Characters before a candidate that are its context.
CONTEXT = 40
# Words that announce a secret, in the languages of the corpus.
GAZETTEER = (
    "password passwd pwd passphrase secret token apikey api_key api-key access_key auth bearer "
    "credential passwort kennwort geheim motdepasse mdp contraseña clave"
).split()
_WORDS = "(?i)(?:" + "|".join(GAZETTEER) + ")"
VOTERS = ("pattern", "gazetteer", "context", "shape", "plain")


def _matches(text: Column, pattern: str, quick: Column) -> Column:
    """Non-overlapping matches from the left, and the texts between them; ``quick`` says
    where there can be any."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    between = F.split(text, pattern, -1)
    return F.when(quick, F.struct(found.alias("m"), between.alias("b")))


def _placed(parts: Column) -> Column:
    """Matches with their places, by one pass over matches and what lies between them."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<x:string,start:int,end:int>>").alias("out"))
    walked = F.aggregate(
        F.arrays_zip(F.slice(parts["b"], 1, F.size(parts["m"])).alias("b"), parts["m"].alias("m")),
        first,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["b"]) + F.length(p["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        p["m"].alias("x"),
                        (acc["at"] + F.length(p["b"])).alias("start"),
                        (acc["at"] + F.length(p["b"]) + F.length(p["m"])).alias("end"),
                    )
                ),
            ).alias("out"),
        ),
    )["out"]
    return F.when(parts.isNotNull() & (F.size(parts["m"]) > 0), walked).otherwise(
        F.array().cast("array<struct<x:string,start:int,end:int>>")
    )


def _valid_ip(x: Column) -> Column:
    # A part is at most 255; leading zeros don't count.
    return F.forall(F.split(x, "\\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _valid_card(x: Column) -> Column:
    digits = F.reverse(F.split(_digits(x), ""))
    total = F.aggregate(
        F.transform(digits, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5))),
        F.lit(0).cast("bigint"),
        lambda s, d: s + d.cast("bigint"),
    )
    return F.length(_digits(x)).between(16, 19) & (total % 10 == 0)


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Base spans and candidates of every row, from one reading of the text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.select(F.col(key).alias("key"), body.alias("t"))
    digit = F.col("t").rlike("[0-9]")
    out = out.select(
        "key",
        "t",
        _matches(F.col("t"), EMAIL, F.col("t").contains("@")).alias("e"),
        _matches(F.col("t"), IP, digit & F.col("t").rlike("[0-9]\\.[0-9]")).alias("i"),
        _matches(F.col("t"), CARD, digit & F.col("t").rlike("[0-9][\\x20-]?[0-9]")).alias("c"),
        _matches(F.col("t"), PHONE, F.col("t").rlike("\\+[0-9]")).alias("p"),
        _matches(F.col("t"), CANDIDATE, digit).alias("s"),
    )
    out = out.select("key", "t", *[_placed(F.col(c)).alias(c) for c in "eicps"])
    return out.select(
        "key",
        "t",
        F.col("e"),
        F.filter("i", lambda m: _valid_ip(m["x"])).alias("i"),
        F.filter("c", lambda m: _valid_card(m["x"])).alias("c"),
        F.filter("p", lambda m: F.length(_digits(m["x"])).between(8, 15)).alias("p"),
        F.col("s"),
    )


def _candidates() -> Column:
    """The candidates of a row that no base span overlaps."""
    base = F.concat("e", "i", "c", "p")
    return F.filter("s", lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))


def _votes(x: Column, before: Column) -> Column:
    """The voters' votes on a candidate: 1 yes, 0 no, -1 abstains."""
    digits, letters = F.length(_digits(x)), F.length(F.regexp_replace(x, "[^A-Za-z]", ""))
    yes_no = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    known = x.rlike("^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|xox[abp]-.*|eyJ[A-Za-z0-9_-]{20,})$")
    hexes = x.rlike("^[0-9a-f]{16,}$") & (letters > 0)
    return F.array(
        yes_no(known | hexes, x.rlike("^[0-9+/-]+$")),
        yes_no(before.rlike(_WORDS + "[\"' ]*[:=][\"' ]*$"), F.lit(False)),
        yes_no(before.rlike("[:=\"'] *$") | before.rlike(_WORDS), before.rlike("[a-zß-ÿ,.]{2,} +$") & ~known),
        yes_no((digits >= 4) & (letters >= 4), (digits < 2) | (letters < 2)),
        yes_no(F.lit(False), x.rlike("^[a-z]+[-_/][a-z0-9-_/]*$|^[0-9]{4}-[0-9]{2}|/.*/")),
    )


def _features(x: Column, before: Column) -> Column:
    """The classifier's features of a candidate, each of a few values."""
    left = F.substring(before, -1, 1)
    return F.array(
        F.least(F.floor(F.length(x) / 4), F.lit(8)).cast("string"),
        F.floor(F.length(_digits(x)) * 4 / F.length(x)).cast("string"),
        F.concat(x.rlike("[a-z]").cast("int").cast("string"), x.rlike("[A-Z]").cast("int").cast("string")),
        x.rlike("[_+/-]").cast("string"),
        F.when(before == "", "^").when(left.rlike("[\\x21-\\x7e]"), left).when(left.rlike("\\s"), " ").otherwise("?"),
        F.lower(F.regexp_extract(before, "(" + _WORDS + ")", 1)),
        F.least(F.size(F.split(x, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")), F.lit(9)).cast("string"),
    )


def _before(m: Column) -> Column:
    begin = F.greatest(m["start"] - CONTEXT, F.lit(0))
    return F.substring(F.col("t"), begin + 1, m["start"] - begin)


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50):
    """Posterior of each vote pattern, and each voter's rates of yes for true and false.

    Expectation-maximisation for voters that err independently. Abstaining tells
    nothing. Starts from the share of yes votes; a pattern without votes stays at the
    share of true candidates.
    """
    voters = range(len(patterns[0][0])) if patterns else range(0)
    post = {}
    for votes, _ in patterns:
        cast = [v for v in votes if v >= 0]
        post[votes] = (sum(cast) + 0.5) / (len(cast) + 1.0)
    rates, share = [], 0.5
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        share = (sum(post[v] * n for v, n in patterns) + 1) / (total + 2) if total else 0.5
        rates = []
        for k in voters:
            yes_true = 2.0 + sum(post[v] * n for v, n in patterns if v[k] == 1)
            all_true = 2.5 + sum(post[v] * n for v, n in patterns if v[k] >= 0)
            yes_false = 0.5 + sum((1 - post[v]) * n for v, n in patterns if v[k] == 1)
            all_false = 2.5 + sum((1 - post[v]) * n for v, n in patterns if v[k] >= 0)
            rates.append((yes_true / all_true, yes_false / all_false))
        for votes, _ in patterns:
            odds = math.log(share / (1 - share))
            for k in voters:
                if votes[k] == 1:
                    odds += math.log(rates[k][0] / rates[k][1])
                elif votes[k] == 0:
                    odds += math.log((1 - rates[k][0]) / (1 - rates[k][1]))
            post[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, rates, share


def train(candidates: DataFrame) -> tuple[float, dict[tuple[int, str], float]]:
    """Weights of feature values and a bias, from all candidates' votes.

    Spark counts candidates by votes and features; both take few values, so the driver
    gets a table whose size doesn't grow with the corpus. The weights are the log ratios
    with which a value occurs among true and false candidates.
    """
    counted = candidates.groupBy("votes", "features").agg(F.count("*").alias("n")).collect()
    by_votes: dict[tuple[int, ...], int] = defaultdict(int)
    for row in counted:
        by_votes[tuple(row["votes"])] += row["n"]
    post, _, share = reliabilities(sorted(by_votes.items()))
    true, false = defaultdict(float), defaultdict(float)
    for row in sorted(counted, key=lambda r: (tuple(r["votes"]), tuple(r["features"]))):
        p = post[tuple(row["votes"])]
        for k, value in enumerate(row["features"]):
            true[(k, value)] += p * row["n"]
            false[(k, value)] += (1 - p) * row["n"]
    all_true = sum(post[v] * n for v, n in by_votes.items())
    all_false = sum((1 - post[v]) * n for v, n in by_votes.items())
    weights = {
        f: round(math.log((true[f] + 0.5) / (all_true + 1)) - math.log((false[f] + 0.5) / (all_false + 1)), 6) for f in sorted(set(true) | set(false))
    }
    return round(math.log(share / (1 - share)), 6), weights


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and an array of ``spans`` (kind, start, end in code points) for every row.

    Base spans of the four kinds are always in; the classifier adds secrets, which never
    overlap them. A null text counts as empty. Every row gives a row, also if keys
    repeat or are null; whole texts are read. Other columns are ignored. Without any
    candidate nothing is added.
    """
    found = _found(docs, key, text).withColumn("s", _candidates())
    each = found.where("size(s) > 0").select("t", F.explode("s").alias("m")).select("m.x", _before(F.col("m")).alias("before"))
    bias, weights = train(each.select(_votes(F.col("x"), F.col("before")).alias("votes"), _features(F.col("x"), F.col("before")).alias("features")))
    entries = [F.lit(v) for (k, value), w in weights.items() for v in (f"{k}={value}", w)]
    table = F.create_map(*entries) if entries else F.create_map().cast("map<string,double>")

    def score(m: Column) -> Column:
        names = F.transform(_features(m["x"], _before(m)), lambda f, k: F.concat(k.cast("string"), F.lit("="), f))
        return F.aggregate(names, F.lit(bias), lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))

    span = lambda m, kind: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    spans = lambda c, kind: F.transform(c, lambda m: span(m, kind))
    base = [spans(c, kind) for c, kind in zip("eicp", KINDS)]
    added = spans(F.filter("s", lambda m: score(m) > 0), KINDS[4])
    return found.select(F.col("key").alias(key), F.concat(*base, added).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their hash, and all spans as text."""
    found = find(docs)
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[4])
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        count(KINDS[4]),
    )
