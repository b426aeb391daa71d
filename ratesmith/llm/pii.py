"""Personal data by weak supervision.

Base patterns (email, ip, card, phone) always count.  Looser patterns give
candidates for more: written-out addresses, national phone numbers, social
security numbers and bank accounts.  Regular-expression, gazetteer and context
labelers vote on every candidate, base matches included; EM estimates how
reliable each labeler is from the counts of vote patterns over all documents,
and a logistic span classifier is trained on the resulting soft labels.
Candidates that it accepts, and that overlap no base span, are added.

Extraction, votes, counts and scores are column expressions; the driver holds
the distinct vote and feature patterns only (a few hundred rows at most).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.llm.spans import SPAN, blocks_of, count_before, join_spans, let, locate, overlaps_any, piece_of
from ratesmith.llm.weak_supervision import estimate_reliabilities, fit_logistic

BASE = ("email", "ip", "card", "phone")
EXTRA = ("address", "local_phone", "ssn", "iban")
#: Characters before and after a candidate that labelers read.
CONTEXT = 40
ACCEPT = 0.5
#: Gazetteers: endings of host names, first digits of card issuers, country
#: codes of bank accounts.
HOST_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "it", "eu")
CARD_ISSUERS = "(?:4|5[1-5]|2[2-7]|3[47]|6)"
IBAN_COUNTRIES = "(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
WORDS_FOR = (r"(?i)(?:e-?mail|mail|contact|write|reach|call|phone|tel|fax|mobile|card|visa|"
             r"pay|account|iban|bank|ssn|social|security|address|kontakt|telefon|correo|appel)")
WORDS_AGAINST = (r"(?i)(?:version|release|isbn|issn|doi|page|chapter|section|order|invoice|"
                 r"figure|table|build|serial|model|license)")

# A run of local-part characters fails as a whole or not at all, so a match
# starts at the run's first character or where the last match ended.
_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_ADDRESS = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\{at\})\x20?"
            r"[A-Za-z0-9-]{1,64}+(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{1,64}+){1,4}+")
_LOCAL_PHONE = r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,4})?(?![0-9A-Za-z])"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    def step(total: Column, k: Column) -> Column:
        d = F.substr(digits, F.length(digits) - k + 1, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(k % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans of the four base kinds, in the text's order."""
    has_digit = text.rlike("[0-9]")
    found = {
        "email": locate(text, _EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(locate(text, _IP, text.rlike(r"[0-9]\.[0-9]")),
                       lambda s: s["match"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": F.filter(locate(text, _CARD, has_digit), lambda s: (
            F.length(_digits(s["match"])).between(13, 19) & luhn(_digits(s["match"])))),
        "phone": F.filter(locate(text, _PHONE, F.contains(text, F.lit("+"))),
                          lambda s: F.length(_digits(s["match"])).between(9, 15)),
    }
    return {kind: found[kind] for kind in BASE}


def extra_candidates(text: Column) -> dict[str, Column]:
    """Candidate spans of the looser kinds."""
    has_digit = text.rlike("[0-9]{2}")
    return {"address": locate(text, _ADDRESS, text.rlike(r"[(\[{]at[)\]}]")),
            "local_phone": locate(text, _LOCAL_PHONE, has_digit),
            "ssn": locate(text, _SSN, has_digit),
            "iban": locate(text, _IBAN, text.rlike("[A-Z]{2}[0-9]{2}"))}


def _votes(kind: str, blocks: Column, span: Column) -> Column:
    """Votes (1 yes, -1 no, 0 abstain) of five labelers on one span."""
    m, digits = span["match"], _digits(span["match"])
    before = piece_of(blocks, F.greatest(span["start"] - CONTEXT, F.lit(0)),
                      F.least(span["start"], F.lit(CONTEXT)))
    after = piece_of(blocks, span["end"], F.lit(CONTEXT))

    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(F.lit(True) if no is None else no, -1).otherwise(0)

    ending = F.regexp_extract(F.lower(m), r"([a-z]+)$", 1)
    strict = {"email": F.lit(True), "ip": F.lit(True), "card": F.lit(True), "phone": F.lit(True),
              "address": m.rlike(r"^[^\x20]+\x20?[(\[{]at[)\]}]"),
              "local_phone": m.rlike(r"^\(|-.*-|\..*\."),
              "ssn": ~m.rlike(r"^(?:000|666|9[0-9]{2})|-00-|-0000$"),
              "iban": F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34)}[kind]
    known = {"email": vote(ending.isin(*HOST_ENDINGS)),
             "address": vote(ending.isin(*HOST_ENDINGS)),
             "card": vote(digits.rlike("^" + CARD_ISSUERS)),
             "iban": vote(m.rlike("^" + IBAN_COUNTRIES)),
             "ip": vote(~m.rlike(r"^(?:0|1|2)\.[0-9]\.")),
             "phone": vote(~digits.rlike(r"^0"), F.lit(True)),
             "local_phone": vote(~digits.rlike(r"^[01]")),
             "ssn": F.lit(0)}[kind]
    varied = ~(F.length(digits) >= 6) | (F.size(F.array_distinct(F.split(digits, ""))) > 3)
    apart = (~before.rlike(r"[\p{L}\p{N}_]$")) & ~after.rlike(r"^[\p{L}\p{N}_]")
    return F.array(vote(strict), known, vote(before.rlike(WORDS_FOR), before.rlike(WORDS_AGAINST)),
                   vote(apart), vote(varied))


def _features(kind: Column, votes: Column) -> list[Column]:
    """0/1 features of the span classifier: the looser kinds, and each
    labeler's yes and no."""
    return ([(kind == k).cast("int") for k in EXTRA]
            + [(F.get(votes, F.lit(i)) == v).cast("int") for i in range(5) for v in (1, -1)])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       carry: Sequence[str] = ()) -> DataFrame:
    """Return doc_id, text, the columns named in ``carry`` and, per kind, an
    array of (start, end, match).

    Offsets are code points, the end exclusive.  Null texts count as empty;
    null ids and repeated rows are kept; all other columns are ignored; an
    empty table gives an empty result.
    """
    text = F.col("text")
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carry)
    base = base.select("*", *[c.alias(k) for k, c in base_spans(text).items()],
                       *[c.alias(k) for k, c in extra_candidates(text).items()])
    base = base.withColumns({k: F.filter(k, lambda s: ~overlaps_any(s, [F.col(b) for b in BASE]))
                             for k in EXTRA})

    # blocks only of texts with candidates
    some = F.lit(False)
    for k in BASE + EXTRA:
        some = some | (F.size(k) > 0)
    base = base.withColumn("_blocks", F.when(some, blocks_of(text)))
    blocks = F.col("_blocks")

    def voted(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"),
                                                    _votes(kind, blocks, s).alias("votes")))

    cast = base.select(F.explode(F.concat(*[voted(k) for k in BASE + EXTRA])).alias("c")
                       ).select("c.kind", "c.votes")
    # at most 8 kinds times 3^5 vote patterns
    patterns = [(r["kind"], tuple(r["votes"]), r["n"]) for r in cast.groupBy("kind", "votes").agg(
        F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").toLocalIterator()]
    model = estimate_reliabilities([(votes, n) for _, votes, n in patterns])
    weights = fit_logistic([
        ([float(kind == k) for k in EXTRA] + [float(v == s) for v in votes for s in (1, -1)],
         model.posterior(votes), n) for kind, votes, n in patterns])
    if len(weights) == 1:
        return base.select("doc_id", "text", *carry, *BASE, *[F.array().cast(SPAN).alias(k) for k in EXTRA])

    def accepted(kind: str) -> Column:
        def good(s: Column) -> Column:
            z = F.lit(weights[-1])
            for w, f in zip(weights, _features(F.lit(kind), _votes(kind, blocks, s)), strict=False):
                z = z + F.lit(w) * f
            return 1 / (1 + F.exp(-z)) >= ACCEPT

        return F.filter(kind, good)

    return base.select("doc_id", "text", *carry, *BASE, *[accepted(k).alias(k) for k in EXTRA])


def redact(text: Column, kinds: dict[str, Column]) -> Column:
    """The text with every span replaced by "[kind]"; of overlapping spans the
    first, the longest among those of one start, names the gap.

    Each kind's spans are in order and apart, so what ends last of all that
    precede a span is found by a binary search in every kind.
    """
    ranked = sorted(kinds)

    def named(kind: str) -> Column:
        return F.transform(kinds[kind], lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("last"), F.lit(ranked.index(kind)).alias("kind")))

    def last_end(no: int, kind: str, s: Column) -> Column:
        spans = kinds[kind]
        before = count_before(spans, lambda o: F.struct(
            o["start"].alias("start"), (-o["end"]).alias("last"), F.lit(no).alias("kind")) < s)
        return let(before, lambda k: F.when(k > 0, F.get(spans, k - 1)["end"]))

    def reached(s: Column) -> Column:
        return F.greatest(F.lit(0), *[last_end(no, kind, s) for no, kind in enumerate(ranked)])

    names = F.array(*[F.lit(f"[{k}]") for k in ranked])
    spans = F.array_sort(F.concat(*[named(kind) for kind in ranked]))
    end = F.greatest(F.lit(0), *[F.coalesce(F.try_element_at(kinds[k], F.lit(-1))["end"], F.lit(0)) for k in ranked])

    def cut(blocks: Column) -> Column:
        pieces = F.transform(spans, lambda s: let(reached(s), lambda at: F.when(s["start"] >= at, F.concat(
            piece_of(blocks, at, s["start"] - at), F.get(names, s["kind"])))))
        return F.concat(F.array_join(pieces, ""), piece_of(blocks, end, F.length(text) - end))

    return F.when(F.size(spans) == 0, text).otherwise(let(blocks_of(text), cut))


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the base spans' hash, and all spans."""
    base = [(k, F.col(k)) for k in BASE]
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(join_spans(base), 256).alias("base_sha256"),
                        join_spans(base + [(k, F.col(k)) for k in EXTRA]).alias("spans"))
