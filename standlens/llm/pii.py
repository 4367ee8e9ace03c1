r"""PII detection (operator 10) by weak-supervision aggregation.

Candidates come from the contract's four patterns and from looser ones of further kinds. Labelers vote on each
candidate (+1, -1, or 0 for no opinion): its strict form, its checksum, gazetteers, cue words
around it, cues against it, its borders. Only the counts of equal vote patterns are gathered from the corpus
(kinds x 3^6 rows at most, whatever the data). Expectation-maximisation over them estimates how reliable each
labeler is for each kind and how likely each pattern is personal data; a logistic span classifier is then trained
on the patterns with these probabilities as soft labels. It decides on every candidate; what passes the contract's checks is
found in any case. Whole texts are read, each by itself, so no key can be hot and nothing but counts is shuffled.

Defined cases: a null or empty text has no spans; null ids and repeated rows are rows like others; of
added candidates that overlap, the likelier one stays, then the longer, then the earlier, and none that
overlaps a base span; with no candidate anywhere the classifier keeps its prior; an empty table
gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, slices

#: The kinds in the order in which equal starts are listed; the first four are the contract's.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "mac", "name", "address", "birthdate")
LABELERS = ("form", "checksum", "gazetteer", "cue", "counter", "border")
#: What each labeler's reliability is taken to be before any text is seen.
PRIOR = np.array([0.7, 0.98, 0.8, 0.9, 0.9, 0.7])

#: Gazetteers.
TOP_LEVELS = "com org net edu gov mil int info biz io ai co uk de fr es it nl ch at be pl se no dk fi pt ie eu us ca au jp cn in br ru".split()
HONORIFICS = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña".split()
FIRST_NAMES = """James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth
Barbara Susan Jessica Sarah Karen Hans Peter Klaus Wolfgang Jürgen Ursula Monika Sabine Anna Jean Pierre Michel Philippe
Marie Nathalie Isabelle Sophie José Juan Carlos Luis Carmen Ana Laura Pablo Emma Olivia Noah Liam""".split()
STREETS = "Street St Avenue Ave Road Rd Lane Ln Boulevard Blvd Drive Court Way Square Straße Strasse Platz Weg".split()
IBAN_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split()

#: Words near a candidate that speak for its kind.
CUES = {
    "email": "email e-mail mail correo courriel contact kontakt",
    "ip": "ip address adresse host server login client",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta",
    "phone": "phone tel telephone telefon téléphone teléfono call mobile cell fax ring anrufen appeler llamar",
    "iban": "iban account konto compte cuenta bank",
    "ssn": "ssn social security",
    "mac": "mac ethernet wifi device",
    "name": "name named called signed dear regards contact author",
    "address": "address lives living resides home adresse dirección wohnt",
    "birthdate": "born birth birthday dob geboren geburtsdatum né née naissance nacido nacida nacimiento",
}
#: Words near a candidate that speak against it.
COUNTERS = "version release build isbn issn doi order invoice serial chapter section figure page part revision model".split()

EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits begins: starting inside it needs the same rest
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOOSE = {
    "phone": re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)[ ]?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "mac": re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-])"),
    "birthdate": re.compile(r"(?<![\w./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![\w/-])"),
    "address": re.compile(r"(?<![\w-])[0-9]{1,5}[ ](?:[A-Z]\w{1,20}[ ]){1,3}(?:" + "|".join(STREETS) + r")(?!\w)"),
}
NAME = re.compile(r"(?<!\w)(?:(?:" + "|".join(HONORIFICS) + r")\.?[ ][A-Z]\w{1,30}(?:[ ][A-Z]\w{1,30})?|(?:"
                  + "|".join(FIRST_NAMES) + r")[ ][A-Z]\w{1,30})(?!\w)")
# nearly every text fails these quickly, and then the patterns behind them need not be tried
DIGIT = re.compile("[0-9]")
STRICT = {
    "email": re.compile(r"[A-Za-z0-9][\w.%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "ip": re.compile(r"(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})"),
    "card": re.compile(r"[0-9]{14,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ ]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]+|(?:[ ][A-Z0-9]{4})+(?:[ ][A-Z0-9]{1,3})?)"),
}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in s.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern: from each @ the local part is read backwards, not beyond the
    match before, so that long runs of letters are passed once."""
    done, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and text[left - 1] in EMAIL_LEFT:
            left -= 1
        m = EMAIL_RIGHT.match(text, at + 1) if left < at else None
        if m:
            yield left, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans that pass the contract's checks, matches that fail them)."""
    good: list[tuple[str, int, int]] = []
    bad: list[tuple[str, int, int]] = []
    if "@" in text:
        good += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            (good if octets(m.group()) else bad).append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() < 14:
                continue
            d = digits_of(m.group())
            if 14 <= len(d) <= 19:
                (good if luhn(d) else bad).append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                (good if 10 <= len(digits_of(m.group())) <= 15 else bad).append(("phone", m.start(), m.end()))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(good, key=lambda s: (s[1], order[s[0]])), bad


def loose_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if DIGIT.search(text):
        for kind, rx in LOOSE.items():
            for m in rx.finditer(text):
                yield kind, m.start(), m.end()
    for m in NAME.finditer(text):
        yield "name", m.start(), m.end()


WORD = re.compile(r"[\w-]+")
SENTENCE = re.compile(r"[.;!?]\s|\n")
CUE_SETS = {k: frozenset(v.split()) for k, v in CUES.items()}
COUNTER_SET = frozenset(COUNTERS)


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """The labelers' votes on a candidate, in the order of LABELERS."""
    s = text[start:end]
    before, after = SENTENCE.split(text[max(0, start - 48):start])[-1], SENTENCE.split(text[end:end + 16])[0]
    around = {w.lower() for w in WORD.findall(before) + WORD.findall(after)}
    form = (1 if STRICT[kind].fullmatch(s) else -1) if kind in STRICT else 0
    checksum = gazetteer = 0
    if kind == "ip":
        checksum = 1 if octets(s) else -1
        gazetteer = -1 if s.startswith(("0.", "127.", "255.")) else 0
    elif kind == "card":
        checksum = 1 if luhn(digits_of(s)) else -1
        gazetteer = 1 if s[0] in "3456" else -1
    elif kind == "email":
        gazetteer = 1 if s.rpartition(".")[2].lower() in TOP_LEVELS else -1
    elif kind == "phone":
        checksum = 0 if 10 <= len(digits_of(s)) <= 15 else -1
        gazetteer = 1 if s[0] in "+(" else 0
    elif kind == "iban":
        plain = s.replace(" ", "")
        checksum = 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1
        gazetteer = 1 if s[:2] in IBAN_COUNTRIES else -1
    elif kind == "ssn":
        checksum = -1 if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else 1
    elif kind == "birthdate":
        year = int(s[-4:] if s[-4:].isdigit() else s[:4])
        checksum = 1 if 1900 <= year <= 2025 else -1
    elif kind == "name":
        words = s.replace(".", "").split()
        gazetteer = 1 if words[0] in HONORIFICS and (len(words) > 2 or words[1] in FIRST_NAMES) or words[0] in FIRST_NAMES else 0
    elif kind == "address":
        gazetteer = 1 if s.rpartition(" ")[2] in STREETS else 0
    cue = 1 if around & CUE_SETS[kind] else (-1 if kind == "birthdate" else 0)
    counter = -1 if around & COUNTER_SET else 0
    edges = text[start - 1:start] + text[end:end + 1]
    border = -1 if any(c.isalnum() or c in "_=#/" for c in edges) else 0
    return form, checksum, gazetteer, cue, counter, border


class Model:
    """Reliabilities by kind and labeler, and the span classifier's weights."""

    def __init__(self, reliability: np.ndarray, weights: np.ndarray) -> None:
        self.reliability, self.weights = reliability, weights
        self.known: dict[tuple, float] = {}

    def score(self, kind: str, v: tuple[int, ...]) -> float:
        if (kind, v) not in self.known:                   # as many as there are patterns
            self.known[kind, v] = float(1 / (1 + np.exp(-features([(kind, v)])[0] @ self.weights)))
        return self.known[kind, v]


def features(patterns: list[tuple[str, tuple[int, ...]]]) -> np.ndarray:
    """Kind (one-hot), and each labeler's vote for and against."""
    v = np.array([p for _, p in patterns]).reshape(-1, len(LABELERS))
    kinds = np.array([[k == x for x in KINDS] for k, _ in patterns], float).reshape(-1, len(KINDS))
    return np.hstack([kinds, v > 0, v < 0]).astype(float)


def posterior(keys: list[tuple[str, tuple]], reliability: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Probability of each (kind, votes) to be personal data, the labelers being independent given the truth."""
    if not keys:
        return np.empty(0)
    kind = np.array([KINDS.index(k) for k, _ in keys])
    a = np.log(reliability / (1 - reliability))[kind]
    z = np.log(share / (1 - share))[kind] + (a * np.array([v for _, v in keys])).sum(1)
    return 1 / (1 + np.exp(-z))


def estimate(patterns: Counter, rounds: int = 60, strength: float = 100.0) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over counted (kind, votes): reliabilities by kind and labeler, share of true ones by kind.

    ``strength`` pseudo-votes hold each number near its prior, so that few candidates cannot turn a labeler
    around, and no reliability falls to chance.
    """
    reliability = np.tile(PRIOR, (len(KINDS), 1))
    share = np.array([0.5 if k in BASE else 0.3 for k in KINDS])
    start = share.copy()
    keys = sorted(patterns)
    if not keys:
        return reliability, share
    v = np.array([p for _, p in keys])
    kind = np.array([KINDS.index(k) for k, _ in keys])
    n = np.array([patterns[k] for k in keys], float)
    for _ in range(rounds):
        p = posterior(keys, reliability, share)
        for k in range(len(KINDS)):
            own = kind == k
            w = n[own]
            share[k] = (w @ p[own] + strength * start[k]) / (w.sum() + strength)
            for j in range(len(LABELERS)):
                right = w @ (np.where(v[own, j] > 0, p[own], 0) + np.where(v[own, j] < 0, 1 - p[own], 0))
                said = w @ (v[own, j] != 0)
                reliability[k, j] = np.clip((right + PRIOR[j] * strength) / (said + strength), 0.52, 0.999)
        share = np.clip(share, 0.02, 0.98)
    return reliability, share


def train(patterns: Counter, steps: int = 4000, rate: float = 1.0, decay: float = 1e-4) -> Model:
    """Reliabilities by EM, then the logistic span classifier: patterns seen, weighted by the log of their counts, and for
    each kind the patterns of no vote and of one vote, all with their probabilities as soft labels."""
    reliability, share = estimate(patterns)
    none = (0,) * len(LABELERS)
    single = [none] + [tuple(s * (i == j) for i in range(len(LABELERS))) for j in range(len(LABELERS)) for s in (1, -1)]
    keys = sorted(patterns)
    alone = [(k, v) for k in KINDS for v in single]
    x, y = features(keys + alone), posterior(keys + alone, reliability, share)
    w = np.concatenate([np.log1p([patterns[k] for k in keys]), np.full(len(alone), 0.5)])
    w /= w.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        got = 1 / (1 + np.exp(-x @ weights))
        weights -= rate * (x.T @ (w * (got - y)) + decay * weights)
    return Model(reliability, weights)


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, further candidates)."""
    good, bad = base_spans(text)
    return good, bad + list(loose_spans(text))


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """A model of all texts; what reaches the driver is one row per (kind, votes) and its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                if text:
                    good, more = candidates(text)
                    found.update((k, votes(text, k, s, e)) for k, s, e in good + more)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.string()), pa.array([list(v) for _, v in found], pa.list_(pa.int32())),
             pa.array(list(found.values()), pa.int64())], ["kind", "votes", "n"])

    rows = arrow_map(docs.select(col(docs, text_col).alias("t")), run, "kind string, votes array<int>, n long")
    return train(Counter({(r.kind, tuple(r.votes)): r.n for r in rows.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()}))


def spans_of(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by start and then kind."""
    base, more = candidates(text)
    scored = sorted(((-model.score(k, votes(text, k, s, e)), s - e, s, k) for k, s, e in more))
    taken, out = [(s, e) for _, s, e in base], list(base)
    for p, size, s, k in scored:
        e = s - size
        if p < -0.5 and all(e <= a or s >= b for a, b in taken):
            taken.append((s, e))
            out.append((k, s, e))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(out, key=lambda x: (x[1], order[x[0]]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans), one row per row of ``docs``; positions are code points, ends exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # a few hundred numbers
    source = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            both = [spans_of(t or "", m) for t in b.column(1).to_pylist()]
            arrays = [pa.array([[dict(zip(("kind", "start", "end"), x)) for x in row] for row in part], pa.list_(SPAN))
                      for part in ([x for x, _ in both], [x for _, x in both])]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], ["id", "base", "spans"])

    id_type = source.schema["id"].dataType.simpleString()
    return arrow_map(source, run, f"id {id_type}, base {SPANS}, spans {SPANS}")


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; of spans that overlap, the text they
    cover together becomes one mark named after the first. The columns of ``docs``; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    plain = docs.select([col(docs, c).alias(f"c{i}") for i, c in enumerate(names)])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            texts = pa.array([t if t is None else masked(t, spans_of(t, m)[1]) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

    return arrow_map(plain, run, plain.schema).toDF(*names)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def op10_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = detect(docs, fit(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(F.col("id").alias("doc_id"), *[count(k) for k in BASE],
                      F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
