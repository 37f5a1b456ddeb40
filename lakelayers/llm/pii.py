"""Personal data by weak supervision; native throughout.

Base patterns give spans that always stay. Narrower and looser patterns give
more candidates, such as a phone number that runs into a card number, and
secrets: keys, tokens and passwords, which no base pattern knows. Pattern,
checksum, gazetteer, context and border labelers vote on every candidate;
expectation-maximisation estimates how reliable each labeler is for each kind;
its posteriors train the span classifier that decides what is added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakelayers.llm.common import written

KINDS = ("email", "ip", "card", "phone", "secret")
# Kinds with a base pattern; secrets are listed by themselves.
LISTED = KINDS[:4]
# The base patterns. The groups that repeat are possessive and do not
# capture, so a long run neither recurses nor backtracks; a look-behind keeps a run of
# local-part characters from being tried from each of its letters (\G: or where the
# last match ended). Neither changes what matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3} ?)?(?:\([0-9]{2,4}\) ?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]{0,128}+[0-9])[A-Za-z0-9+/_-]{16,512}+={0,2}+(?![A-Za-z0-9+/=_-])",
}
# A text without this character holds no candidate of the kind.
NEEDS = {("email", True): "@", ("email", False): "at", ("phone", True): "+"}
BEFORE, AFTER = 48, 16
# Gazetteers: fixed values, from public lists of top-level domains, card issuers and key formats.
DOMAINS = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "ai", "app", "dev", "co", "me", "tv", "cloud", "online",
    "ar", "at", "au", "be", "br", "ca", "ch", "cl", "cn", "cz", "de", "dk", "es", "eu", "fi", "fr", "gr", "hk", "hu", "ie", "il", "in",
    "it", "jp", "kr", "lu", "mx", "nl", "no", "nz", "pe", "pl", "pt", "ro", "ru", "se", "sg", "sk", "tr", "tw", "ua", "uk", "us", "za",
)
KEY_FORMS = (
    "AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk_live_", "sk_test_", "pk_live_", "rk_live_", "sk-", "xoxb-",
    "xoxp-", "xoxa-", "npm_", "pypi-", "eyJ", "ya29", "SG", "dop_v1_", "shpat_",
)
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "35", "60", "65", "62")
CUES = {
    "email": ("mail", "contact", "write", "correo", "schreib", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "secret": ("token", "secret", "passw", "pwd", "api.?key", "access.?key", "private.?key", "bearer", "credential", "auth"),
}
COUNTER_CUES = (
    "version", "license", "isbn", "release", "section", "chapter", "v.", "commit", "revision", "md5", "sha1", "sha256", "checksum", "digest",
    "hash", "uuid", "order", "invoice", "tracking",
)
LABELERS = ("shape", "check", "gazetteer", "context", "border")
FEATURES = ("shape", "check", "gazetteer", "context", "border", "length", "left", "right", "groups")
EM_ROUNDS = 50
# Where expectation-maximisation begins: a vote is right four times in five, and a
# candidate with no more than two votes over those against it is not believed.
VOTE, DOUBT = math.log(4.0), 2.0
SMOOTHING = 1.0


def _found(text: Column, pattern: str, kind: str, base: bool) -> Column:
    """array of (kind, base, nth, gap, hit, before, after): the matches in a text, and the
    code points between each and the one before."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pieces = F.transform(
        F.arrays_zip(gaps.alias("g"), F.slice(gaps, 2, 1 << 30).alias("next"), hits.alias("hit")),
        lambda z, n: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), n.alias("nth"),
            F.char_length(z["g"]).alias("gap"), z["hit"].alias("hit"),
            F.right(z["g"], F.lit(BEFORE)).alias("before"), F.left(z["next"], F.lit(AFTER)).alias("after"),
        ),
    )
    may = text.contains(NEEDS[kind, base]) if (kind, base) in NEEDS else F.lit(True)
    if kind != "email":
        may = may & text.rlike("[0-9]")
    return F.when(may, F.filter(pieces, lambda p: p["hit"].isNotNull())).otherwise(F.lit(None))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: str) -> Column:
    """Whether the digits of a column pass the checksum."""
    at = f"cast(substring({digits}, length({digits}) - i + 1, 1) as int)"
    total = f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 0, {at} * 2 - if({at} > 4, 9, 0), {at}))"
    return F.expr(f"{total} % 10 = 0")


def _octets(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))


def _mixed(hit: Column, before: Column) -> Column:
    """Letters and digits, of at least eight kinds: not a word, a number or a line of one sign. What
    looks like a digest of something counts behind a cue only."""
    mixed = hit.rlike("[A-Za-z]") & hit.rlike("[0-9]") & (F.size(F.array_distinct(F.split(hit, ""))) >= 8)
    cue = F.lower(before).rlike("(?:" + "|".join(CUES["secret"]) + ")")
    return mixed & (~hit.rlike("^[0-9A-Fa-f]+$") | cue)


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): one pass over the texts, written, and the placed matches.

    documents: row, doc_id, hits. spans: row, kind, base, start, end, hit,
    before, after, digits, valid.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = F.array().cast("array<struct<kind:int,base:boolean,nth:int,gap:int,hit:string,before:string,after:string>>")
    found = [_found(F.col("text"), p, k, base) for patterns, base in ((BASE, True), (MORE, False)) for k, p in patterns.items()]
    held = written(slim.select("row", "doc_id", F.flatten(F.array(*[F.coalesce(f, none) for f in found])).alias("hits")), "pii-hits")
    spans = held.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    before = Window.partitionBy("row", "kind", "base").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.char_length("hit")).over(before), F.lit(0)) + F.col("gap")
    spans = (
        spans.withColumn("start", start.cast("long"))
        .withColumn("end", F.col("start") + F.char_length("hit"))
        .withColumn("digits", _digits(F.col("hit")))
    )
    count = F.char_length("digits")
    passes = F.when(count.between(12, 19), luhn("digits")).otherwise(False)
    valid = (
        F.when(F.col("kind") == 0, True).when(F.col("kind") == 1, _octets(F.col("hit")))
        .when(F.col("kind") == 2, passes).when(F.col("kind") == 3, count.between(9, 15)).otherwise(_mixed(F.col("hit"), F.col("before")))
    )
    return held, spans.withColumn("valid", valid).drop("nth", "gap")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _among(value: Column, kind: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    pick = [F.when(kind == KINDS.index(k), value.rlike("(?:" + "|".join(words) + ")")) for k, words in groups.items()]
    return F.coalesce(*pick, F.lit(False))


def labelled(spans: DataFrame) -> DataFrame:
    """Adds one column per labeler (1 yes, -1 no, 0 no opinion) and one per other feature."""
    kind, hit, count = F.col("kind"), F.col("hit"), F.char_length("digits")
    shape = (
        F.when(kind == 0, hit.rlike(r"^[A-Za-z0-9][^@]*(@| ?[\[(]at[\])] ?)[^@]*(\.|[\])] ?)[A-Za-z]{2,24}$"))
        .when(kind == 1, hit.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"))
        .when(kind == 2, hit.rlike(r"^([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"))
        .when(kind == 3, hit.rlike(r"^(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?([ .-]?[0-9]{2,4}){2,4}$"))
        .otherwise(hit.rlike(r"^([0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9].*[0-9]).{16,})$"))
    )
    known = (
        F.when(kind == 0, F.lower(hit).rlike(r"[.)\] ](" + "|".join(DOMAINS) + ")$"))
        .when(kind == 1, ~hit.rlike(r"^0+\."))
        .when(kind == 2, F.col("digits").rlike("^(" + "|".join(ISSUERS) + ")"))
        .when(kind == 3, hit.rlike(r"^(\+[1-9]|\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-])"))  # a country, or an area and exchange
        .otherwise(hit.rlike("^(" + "|".join(KEY_FORMS) + ")"))
    )
    left, right = F.right("before", F.lit(1)), F.left("after", F.lit(1))
    joined = F.coalesce(left.rlike(r"[A-Za-z0-9]"), F.lit(False)) | F.coalesce(right.rlike(r"[A-Za-z0-9]"), F.lit(False))
    cue = _among(F.lower("before"), kind, CUES)
    counter = F.lower("before").rlike("(?:" + "|".join(w.replace(".", r"\.") for w in COUNTER_CUES) + r")\W*$")

    def border(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[.,;:!?)\]]"), 2).when(c.rlike(r"[A-Za-z]"), 3).when(c.rlike("[0-9]"), 4).otherwise(5)

    return spans.withColumns({
        "shape": _vote(shape, ~shape), "check": _vote(F.col("valid"), ~F.col("valid")),
        "gazetteer": _vote(known, ~kind.isin(1, 4) & ~known), "context": _vote(cue, counter), "border": _vote(F.lit(False), joined),
    }).withColumns({
        "length": F.least(F.floor(F.char_length("hit") / 4), F.lit(10)).cast("int"),
        "left": border(left), "right": border(right),
        "groups": F.least(F.regexp_count("hit", F.lit("[0-9]+")), F.lit(9)).cast("int"),
    })


def reliabilities(patterns: list[tuple], rounds: int = EM_ROUNDS) -> dict[int, tuple[float, list[dict[int, float]]]]:
    """kind -> (log prior odds, per labeler: vote -> log-likelihood ratio), by expectation-maximisation.

    ``patterns`` holds (kind, *votes, count): with five labelers at most 243 rows a
    kind, whatever the corpus. Votes are taken to be independent given the truth.
    """
    out = {}
    for kind in {p[0] for p in patterns}:
        own = [(p[1:-1], p[-1]) for p in patterns if p[0] == kind]
        width = len(own[0][0])
        prior = -DOUBT * VOTE
        ratios = [{1: VOTE, 0: 0.0, -1: -VOTE} for _ in range(width)]
        for _ in range(rounds):
            yes = [dict.fromkeys((-1, 0, 1), SMOOTHING) for _ in range(width)]
            no = [dict.fromkeys((-1, 0, 1), SMOOTHING) for _ in range(width)]
            total = [SMOOTHING, SMOOTHING]
            for votes, count in own:
                odds = max(-500.0, min(500.0, prior + sum(r[v] for r, v in zip(ratios, votes))))
                chance = 1 / (1 + math.exp(-odds))
                total[0] += chance * count
                total[1] += (1 - chance) * count
                for n, vote in enumerate(votes):
                    yes[n][vote] += chance * count
                    no[n][vote] += (1 - chance) * count
            prior = math.log(total[0] / total[1])
            ratios = [
                {v: math.log(a[v] / sum(a.values())) - math.log(b[v] / sum(b.values())) for v in (-1, 0, 1)}
                for a, b in zip(yes, no)
            ]
        out[kind] = (prior, ratios)
    return out


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _lookup(values: dict[tuple, float], *keys: Column) -> Column:
    """The value of the keys, 0 where there is none; a literal map of known size."""
    if not values:
        return F.lit(0.0)
    flat = [x for key, v in sorted(values.items()) for x in (F.lit(":".join(map(str, key))), F.lit(float(v)))]
    return F.coalesce(F.try_element_at(F.create_map(*flat), F.concat_ws(":", *[k.cast("string") for k in keys])), F.lit(0.0))


def classified(spans: DataFrame) -> DataFrame:
    """Adds ``score``: the log odds that the trained classifier gives a span."""
    voted = labelled(spans)
    counts = [tuple(r) for r in voted.groupBy("kind", *LABELERS).count().collect()]  # at most 5 * 243 rows
    models = reliabilities(counts)
    kind = F.col("kind")
    weights = {(k, n, v): r for k, (_, ratios) in models.items() for n, name in enumerate(LABELERS) for v, r in ratios[n].items()}
    odds = _lookup({(k,): p for k, (p, _) in models.items()}, kind) + _sum(
        [_lookup(weights, kind, F.lit(n), F.col(name)) for n, name in enumerate(LABELERS)]
    )
    soft = voted.withColumn("chance", 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(500.0)), F.lit(-500.0)))))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f).cast("int").alias("value")) for n, f in enumerate(FEATURES)]))
    # At most 5 kinds * 9 features * 11 values.
    sums = (
        soft.select("kind", "chance", pairs.alias("p")).groupBy("kind", "p.feature", "p.value")
        .agg(F.sum("chance").alias("yes"), F.sum(1 - F.col("chance")).alias("no")).collect()
    )
    totals: dict[tuple, list[float]] = {}
    values: dict[tuple, int] = {}
    for r in sums:
        total = totals.setdefault((r.kind, r.feature), [0.0, 0.0])
        total[0] += r.yes
        total[1] += r.no
        values[r.kind, r.feature] = values.get((r.kind, r.feature), 0) + 1
    learned, priors = {}, {}
    for r in sums:
        yes, no = totals[r.kind, r.feature]
        spread = SMOOTHING * values[r.kind, r.feature]
        learned[r.kind, r.feature, r.value] = math.log((r.yes + SMOOTHING) / (yes + spread)) - math.log((r.no + SMOOTHING) / (no + spread))
        priors[(r.kind,)] = math.log((yes + SMOOTHING) / (no + SMOOTHING))
    score = _lookup(priors, kind) + _sum([_lookup(learned, kind, F.lit(n), F.col(f)) for n, f in enumerate(FEATURES)])
    return soft.withColumn("score", score)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, secrets, row.

    ``spans`` joins ``kind:start:end`` of all spans of the four kinds by start,
    then kind; counts and ``base_sha256`` are of the base spans alone. ``secrets``
    joins ``start:end`` of keys, tokens and passwords. A span that is added
    passes its kind's check, is one the classifier holds more likely than not,
    and overlaps no base span of its kind and no added one that starts before it.
    Whole texts are read, however long. Null text is empty; a text without spans gives an empty list and the digest
    of nothing. Repeated rows each have a result; no rows give none; other
    columns are ignored.

    The texts are read once and only matches leave that pass. Windows and lists
    are of one document, and the models are sums over a few hundred groups.
    """
    held, spans = candidates(docs)
    spans = written(classified(spans), "pii-spans")
    base = spans.where("base and valid").select("row", "kind", "start", "end", F.lit(True).alias("base"))
    added = spans.where("not base and valid and score > 0").select("row", "kind", "start", "end", F.lit(False).alias("base"))
    # Base spans first: what starts within one, or reaches into the next, goes.
    last = Window.partitionBy("row", "kind").orderBy("start", F.col("base").desc(), "end").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy("row", "kind").orderBy("start", F.col("base").desc(), "end").rowsBetween(1, Window.unboundedFollowing)
    free = (
        base.unionByName(added)
        .withColumn("reached", F.coalesce(F.max("end").over(last), F.lit(-1)))
        .withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(following))
        .where("base or (reached <= start and (next is null or next >= end))")
    )
    span = F.struct("start", "kind", "end", "base")
    listed = free.groupBy("row").agg(
        F.sort_array(F.collect_list(span)).alias("all"),
        *[F.sum((F.col("base") & (F.col("kind") == n)).cast("long")).alias(f"n_{k}") for n, k in enumerate(LISTED)],
        F.count_if(F.col("kind") == len(LISTED)).alias("n_secret"),
    )
    kinds = "array(" + ", ".join(f"'{k}'" for k in LISTED) + ")"
    shown = f"x -> concat(element_at({kinds}, x.kind + 1), ':', x.start, ':', x.end)"
    listed = listed.select(
        "row", *[f"n_{k}" for k in LISTED], "n_secret",
        F.expr(f"array_join(transform(filter(all, x -> x.base), {shown}), ',')").alias("base_spans"),
        F.expr(f"array_join(transform(filter(all, x -> x.kind < {len(LISTED)}), {shown}), ',')").alias("spans"),
        F.expr(f"array_join(transform(filter(all, x -> x.kind = {len(LISTED)}), x -> concat(x.start, ':', x.end)), ',')").alias("secrets"),
    )
    return held.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in LISTED],
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_secret", F.lit(0)).cast("long").alias("n_secret"), F.coalesce("secrets", F.lit("")).alias("secrets"), "row",
    )
