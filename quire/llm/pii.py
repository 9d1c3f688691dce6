"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from patterns, strict ones (``BASE``, kept always) and
loose ones.  Four labelers vote on each candidate (+1 personal, -1 not, 0
abstains): its form (checksums, ranges), a gazetteer (top-level domains,
country codes, issuer and key prefixes), context words before it, and the
variety of its characters.  Expectation-maximisation over the counts of vote
patterns estimates every labeler's reliability per kind; the resulting
posteriors train a naive Bayes span classifier over surface features, which
decides on the candidates that are not base spans.

The driver sees counts of vote and feature patterns only, whose number is
bounded by the number of distinct patterns, not by the data.

Defined results: a null text is an empty one and has no spans; repeated rows
give repeated rows; a text of one long run of any character costs linear time;
an empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import cut

KINDS = ["email", "ip", "card", "phone", "key", "secret"]
BASE_KINDS = 4

# The strict patterns.  They find the same leftmost spans as
# their plain forms; the look-behinds only stop a failed run from being tried
# again at each of its characters, possessive loops keep the stack flat.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose patterns: candidates of a kind that are not base spans.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+().-])(?<![0-9+][\x20])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:password|passwd|pwd|token|secret|api_key)\x20?[=:]\x20?\x22?[^\s\x22]{6,}+\x22?",
}
# A text without this has no span of the pattern (cheaper than the pattern).
NEEDS = {"email": "@", "phone": "+"}

# Gazetteers.
TOP_LEVEL_DOMAINS = ["com", "net", "org", "edu", "gov", "io", "info", "co", "de", "fr", "es", "uk", "eu"]
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CUES = {
    "email": r"(?i)(?:mail|contact|write|reach)\W*\w*\W*$",
    "ip": r"(?i)(?:\bip|host|server|address|from)\W*\w*\W*$",
    "card": r"(?i)(?:card|visa|mastercard|credit|pay)\W*\w*\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|contact)\W*\w*\W*$",
    "key": r"(?i)(?:key|aws|access|secret)\W*\w*\W*$",
    "secret": r"(?i)(?:login|account|user|auth)\W*\w*\W*$",
}
COUNTER_CUES = r"(?i)(?:version|v\.|section|isbn|page|chapter|figure|no\.)\W*$"

LABELERS = ["form", "gazetteer", "context", "variety"]
# The classifier's features; the first two are votes from 0 (no) to 2 (yes): a span's
# validity and its context decide with its surface.
FEATURES = ["f_form", "f_context", "f_length", "f_digits", "f_before", "f_after"]
# How often each labeler is right before any data is seen, as (right, votes): a checksum
# or range hardly errs, the others do at times.
PRIORS = {"form": (995.0, 1000.0), "gazetteer": (4.0, 5.0), "context": (4.0, 5.0), "variety": (4.0, 5.0)}
BEFORE, AFTER = 40, 1  # characters of context that labelers and features see


_CANDIDATE = "struct<kind:int,strict:boolean,nth:int,gap:int,hit:string,before:string,after:string>"


def _matches(text: Column, pattern: str, needs: str | None) -> tuple[Column, Column]:
    """Gaps between a pattern's matches (length and edges), and the matches.

    The text is split at the matches and the matches extracted; gaps and
    matches alternate, so positions are running sums of their lengths.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.struct(
        F.length(p).alias("gap"), F.right(p, F.lit(BEFORE)).alias("before"), F.left(p, F.lit(AFTER)).alias("after")))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return (gaps, found) if needs is None else (F.when(text.contains(needs), gaps), F.when(text.contains(needs), found))


def _rows(gaps: str, found: str, kind: int, strict: bool) -> Column:
    """Array of ``_CANDIDATE``: match i with gap i before it and gap i + 1 after it."""
    after = F.transform(F.slice(gaps, 2, F.size(found)), lambda g: g["after"])
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), F.col(found).alias("hit"), after.alias("after"))
    rows = F.transform(zipped, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), i.alias("nth"), z["g"]["gap"].alias("gap"),
        z["hit"].alias("hit"), z["g"]["before"].alias("before"), z["after"].alias("after")))
    return F.coalesce(F.when(F.size(found) > 0, rows).cast(f"array<{_CANDIDATE}>"), F.array().cast(f"array<{_CANDIDATE}>"))


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]", ""))


def _by_kind(**columns: Column) -> Column:
    out = None
    for name, c in columns.items():
        at = F.col("kind") == KINDS.index(name)
        out = F.when(at, c) if out is None else out.when(at, c)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return out.when(no, -1).otherwise(0) if no is not None else out.otherwise(0)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate span (row, doc_id, text_hash, kind, start, stop, base, votes, features);
    a document without any has one row whose ``kind`` is null.  ``row`` tells rows apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    searches = [(KINDS.index(k), p, True, NEEDS.get(k)) for k, p in PATTERNS.items()]
    searches += [(KINDS.index(k), p, False, None) for k, p in LOOSE.items()]
    matched = []
    for n, (_, pattern, _, needs) in enumerate(searches):
        gaps, found = _matches(F.col("__text"), pattern, needs)
        matched += [gaps.alias(f"g{n}"), found.alias(f"m{n}")]
    arrays = [_rows(f"g{n}", f"m{n}", kind, strict) for n, (kind, _, strict, _) in enumerate(searches)]
    keys = ["row", "doc_id", "text_hash"]
    rows = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("__text"))
            .select("doc_id", "text_hash", *matched).withColumn("row", F.monotonically_increasing_id())
            .select(*keys, F.explode_outer(F.concat(*arrays)).alias("c")).select(*keys, "c.*").repartition("row"))
    order = Window.partitionBy("row", "kind", "strict").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("hit")).over(order).cast("int")
    hit = F.col("hit")
    plain = F.regexp_replace(hit, "[^0-9]", "")
    parts_ok = ~F.exists(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) > 3) & ~F.exists(
        F.split(hit, r"\."), lambda p: F.right(p, F.lit(3)).cast("int") > 255)
    card_ok = _digits(hit).between(13, 19) & F.coalesce(F.call_function("luhn_check", plain), F.lit(False))
    phone_ok = _digits(hit).between(9, 15)
    is_base = F.col("strict") & _by_kind(email=F.lit(True), ip=parts_ok, card=card_ok, phone=phone_ok, key=F.lit(False),
                                         secret=F.lit(False))
    domain = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1))
    distinct = F.size(F.array_distinct(F.split(hit, "")))
    form = _by_kind(
        email=_vote(F.length(domain).between(2, 24) & domain.rlike("^[a-z]+$"), F.length(domain) < 2),
        ip=_vote(parts_ok, ~parts_ok), card=_vote(card_ok, ~card_ok), phone=_vote(_digits(hit).between(10, 15), _digits(hit) < 7),
        key=_vote(hit.rlike("[0-9]") & hit.rlike("[A-Z]")), secret=_vote(F.length(hit) >= 12, F.length(hit) < 10))
    gazetteer = _by_kind(
        email=_vote(domain.isin(TOP_LEVEL_DOMAINS)), ip=_vote(~hit.rlike(r"^(?:0|127|255)\."), hit.rlike(r"^(?:0|255)\.")),
        card=_vote(plain.rlike(ISSUERS), ~plain.rlike(ISSUERS)), phone=_vote(hit.rlike(COUNTRY_CODES)),
        key=F.lit(1), secret=_vote(hit.rlike("^(?:password|passwd|pwd|token)")))
    context = _vote(_by_kind(**{k: F.col("before").rlike(CUES[k]) for k in KINDS}), F.col("before").rlike(COUNTER_CUES))
    variety = _vote(distinct >= 5, distinct <= 2)

    def neighbour(c: Column) -> Column:
        return (F.when(c == "", 0).when(c.rlike(r"[\s]"), 1).when(c.rlike(r"[0-9]"), 2).when(c.rlike(r"[\p{L}]"), 3)
                .otherwise(4))

    spans = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("hit"))
    return spans.select(
        *keys, "kind", "start", "stop", is_base.alias("base"),
        form.alias("form"), gazetteer.alias("gazetteer"), context.alias("context"), variety.alias("variety"),
        (form + 1).alias("f_form"), (context + 1).alias("f_context"),
        F.least(F.floor(F.length("hit") / 4), F.lit(12)).cast("int").alias("f_length"),
        F.floor(4 * _digits(hit) / F.length("hit")).cast("int").alias("f_digits"),
        neighbour(F.right("before", F.lit(1))).alias("f_before"), neighbour(F.col("after")).alias("f_after"))


VOTES = (-1, 0, 1)


def reliabilities(patterns: list[tuple[tuple, int]], rounds: int = 50) -> tuple[float, list[dict]]:
    """EM over (votes, count): the share of personal spans, and per labeler how likely each vote
    is on a personal span (1) and on another (0).

    Votes on both classes are estimated apart, so a labeler that says yes to everything
    comes out as saying nothing, however often it is right.
    """
    share, given = 0.7, [_rates(x, None) for x in LABELERS]
    for _ in range(rounds):
        total = mass = 1e-9
        seen = [{(c, v): 0.0 for c in (0, 1) for v in VOTES} for _ in LABELERS]
        for votes, n in patterns:
            p = posterior(votes, share, given)
            total += n
            mass += n * p
            for j, v in enumerate(votes):
                seen[j][1, v] += n * p
                seen[j][0, v] += n * (1 - p)
        share = min(max(mass / total, 0.01), 0.99)
        given = [_rates(x, s) for x, s in zip(LABELERS, seen)]
    return share, given


def _rates(labeler: str, seen: dict | None) -> dict:
    """(class, vote) -> probability of the vote, from the prior and what was seen."""
    right, votes = PRIORS[labeler]
    prior = {(c, v): votes / 2 if v == 0 else right if (v > 0) == (c == 1) else votes - right for c in (0, 1) for v in VOTES}
    counts = {k: prior[k] + (seen[k] if seen else 0.0) for k in prior}
    sums = {c: sum(counts[c, v] for v in VOTES) for c in (0, 1)}
    return {(c, v): counts[c, v] / sums[c] for c, v in counts}


def posterior(votes: tuple, share: float, given: list[dict]) -> float:
    z = math.log(share / (1 - share)) + sum(math.log(g[1, v] / g[0, v]) for v, g in zip(votes, given))
    return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


SMOOTH = 2.0  # spans of the pooled distribution that a class starts from


def train(spans: DataFrame) -> tuple[dict, dict]:
    """(reliabilities by kind, classifier): log odds by kind and by (kind, feature, value).

    One grouped count over all candidates; labelers have 3 votes each and
    features at most 13 values, so the patterns are few.  A class's feature rates start
    from those of both classes together: a value that says nothing weighs nothing,
    even if one class is rare.
    """
    rows = (spans.filter("kind IS NOT NULL").groupBy("kind", *LABELERS, *FEATURES).count().collect())
    by_kind = defaultdict(lambda: defaultdict(int))
    for r in rows:
        by_kind[r["kind"]][tuple(r[x] for x in LABELERS)] += r["count"]
    trust = {k: reliabilities(sorted(v.items())) for k, v in by_kind.items()}
    yes, no = defaultdict(float), defaultdict(float)
    for r in rows:
        p = posterior(tuple(r[x] for x in LABELERS), *trust[r["kind"]])
        for key in [(r["kind"],), *((r["kind"], f, r[f]) for f in FEATURES)]:
            yes[key] += p * r["count"]
            no[key] += (1 - p) * r["count"]
    odds = {}
    for key in yes:
        k = key[:1]
        if len(key) == 1:
            odds[key] = math.log((yes[key] + 1) / (no[key] + 1))
        else:
            pooled = SMOOTH * (yes[key] + no[key]) / (yes[k] + no[k])
            odds[key] = math.log((yes[key] + pooled) / (yes[k] + SMOOTH)) - math.log((no[key] + pooled) / (no[k] + SMOOTH))
    return trust, odds


def is_personal(odds: dict) -> Column:
    """The trained classifier as a column over kind and features."""
    z = F.lit(0.0)
    tables = defaultdict(list)
    for key, v in sorted(odds.items(), key=str):
        tables[key[1] if len(key) > 1 else ""].append((key[0] * 100 + (key[2] if len(key) > 1 else 0), v))
    for name, entries in tables.items():
        lookup = F.create_map(*[F.lit(x) for e in entries for x in e])
        at = F.col("kind") * 100 + (F.col(name) if name else F.lit(0))
        z = z + F.coalesce(F.element_at(lookup, at), F.lit(0.0))
    return z >= 0


def decide(spans: DataFrame) -> DataFrame:
    """The rows of ``candidates`` (written once, as they train the classifier
    and are judged by it) with ``chosen``: is the span personal?"""
    spans = cut(spans)
    _, odds = train(spans)
    return spans.withColumn("chosen", F.col("kind").isNotNull() & (F.col("base") | is_personal(odds)))


def find_personal(docs: DataFrame) -> DataFrame:
    """(row, doc_id, spans) for every row of ``docs``; spans are (kind, start, stop,
    added) by kind, then start; each span counts once."""
    span = F.struct("kind", "start", "stop", (~F.col("base")).alias("added"))
    return decide(candidates(docs)).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set(F.when(F.col("chosen"), span))).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every personal span of ``text`` replaced by its kind, as ``[EMAIL]``.

    Of overlapping spans the first is named and the rest is cut with it.  Texts
    are joined with their spans by id and hash; rows without spans stay as they are.
    """
    found = (decide(candidates(docs)).filter("chosen").select("doc_id", "text_hash", "kind", "start", "stop").distinct())
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("stop"), "kind")
    before = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    apart = found.withColumn("since", before).filter(F.col("stop") > F.col("since"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    piece = F.struct("start", "since", "stop", F.element_at(names, F.col("kind") + 1).alias("name"))
    cuts = (apart.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
            .agg(F.sort_array(F.collect_list(piece)).alias("__cuts")))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts["__id"]) & (F.xxhash64(docs["text"]) == cuts["__hash"]), "left")
    # each piece: the text since the last cut, then the name unless the span began inside that cut
    where, text = cuts["__cuts"], docs["text"]
    pieces = F.transform(where, lambda c: F.concat(
        F.substring(text, c["since"] + 1, F.greatest(c["start"] - c["since"], F.lit(0))),
        F.when(c["start"] >= c["since"], c["name"]).otherwise("")))
    tail = F.substring(text, F.element_at(where, -1)["stop"] + 1, F.length(text))
    clean = F.when(where.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return joined.select(*[clean.alias(c) if c == "text" else docs[c] for c in docs.columns])


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``."""
    found = find_personal(docs)
    base = F.filter("spans", lambda s: ~s["added"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
