"""Personal data found by labelers that vote, expectation-maximisation that weighs them, and a classifier of spans.

Four kinds have fixed rules and are always reported.  Of four more, candidates
are found loosely, and labelers vote on each: patterns of its form, gazetteers of
names and places, and the words around it.  Nobody has labelled any of them.
Expectation-maximisation over how often each combination of votes occurs in the
whole corpus estimates how reliable each labeler is and how likely each candidate
is personal data.  A logistic model of votes, form and neighbouring words learns
these probabilities from a bounded sample of distinct candidates, and decides.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.tables import ship_package, stored

# Distinct candidates (kind, votes, features) the classifier learns from, at most; the first by a hash.
SAMPLE = 20_000
ACCEPT = 0.5

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("name", "address", "number", "birth")
KINDS = BASE_KINDS + MORE_KINDS

Span = tuple[int, int]

# --- kinds with fixed rules ----------------------------------------------------

# Fixed values of the query's contract: an e-mail's characters before @ and what follows it, dotted numbers, digits with
# single separators, and international numbers.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def emails(text: str) -> list[Span]:
    """What `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+` finds, in linear time: from each @ to both sides."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at) if at > free else None
        if found:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, found.end()))
                free = found.end()
        at = text.find("@", at + 1)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def ips(text: str) -> list[Span]:
    """Four dotted numbers up to 255; a longer row of dotted numbers is taken four by four."""
    out = []
    for found in _DOTTED.finditer(text):
        parts = found.group().split(".")
        start = found.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = start + sum(map(len, own)) + 3
            if all(map(_small, own)):
                out.append((start, end))
            start = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for found in _DIGITS.finditer(text):
        if 14 <= found.end() - found.start() <= 37:
            digits = _NOT_DIGIT.sub("", found.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(found.span())
    return out


def phones(text: str) -> list[Span]:
    out = []
    for found in _PHONE.finditer(text):
        if 10 <= sum(map(found.group().count, "0123456789")) <= 15:
            out.append(found.span())
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the kinds with fixed rules, by start and then kind as listed."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for place, find in enumerate((ips, cards, phones), 1):
            found += [(a, place, b) for a, b in find(text)]
    return [(a, b, BASE_KINDS[place]) for a, place, b in sorted(found)]


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- candidates ------------------------------------------------------------------

_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_WORD = rf"[{_UP}][{_LOW}]{{1,30}}"
_CANDIDATES = {
    "name": re.compile(rf"(?<!\w){_WORD}(?:\x20(?:de\x20|von\x20|van\x20)?{_WORD}){{1,2}}(?!\w)"),
    "address": re.compile(
        rf"(?<![\w.])[0-9]{{1,5}}[a-z]?,?\x20(?:(?:rue|avenue|boulevard|place)\x20(?:de\x20|du\x20|la\x20|des\x20){{0,2}})?(?:{_WORD}\x20){{0,3}}{_WORD}(?!\w)"
        rf"|(?<!\w)(?:{_WORD}\x20){{0,2}}{_WORD}\x20[0-9]{{1,4}}(?![\w.-])"
    ),
    "number": re.compile(r"(?<![\w.])(?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)|\(?[0-9](?:[().\x20/-]{0,2}[0-9]){6,23}(?![\w]))"),
    "birth": re.compile(r"(?<![\w./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}){1,2}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![\w/-])"),
}

# Gazetteers and context words, plainly as such lists are published; short, as they only have to vote.
_GIVEN = frozenset(
    """ana andrew anna anne antonio barbara brian carlos carmen catherine charles christine claire daniel david
    elena elizabeth emily emma eric fatima francisco frank george hans helen isabel jack james jan jane javier jean
    jennifer jessica john jorge jose josef joseph juan julia karen karl katharina kevin klaus laura linda lisa louis
    lucia luis manuel maria marie mark martin mary matthew michael michel miguel monika nancy nicolas olga patricia paul
    pedro peter philippe pierre richard robert sabine sandra sarah sofia sophie stefan steven susan thomas ursula
    william wolfgang""".split()
)
_NO_NAMES = frozenset(
    """april august avenue bank chapter city college company congress corporation council december department east
    europe february figure friday germany france spain government institute january journal july june king march
    monday museum new north november october page party president road saturday school section september south
    state states street sunday the thursday tuesday united university wednesday west war world""".split()
)
_STREETS = frozenset(
    """street st road rd avenue ave lane ln drive dr boulevard blvd court ct square terrace rue place calle
    plaza paseo weg platz allee gasse strasse straße""".split()
)
_TITLES = frozenset("mr mrs ms miss dr prof sir dear herr frau señor señora don doña monsieur madame mme signed regards name named".split())
_SAYS = frozenset("said says wrote lives lived works born phoned emailed told dijo dit sagte wohnt vive habite".split())
_OF_PLACE = frozenset("the in at of to from der die das el la le les los las".split())
_LIVES = frozenset("address at live lives living resides located wohnt adresse anschrift dirección vive habite home".split())
_CALLS = frozenset(
    """tel telephone phone call mobile cell fax whatsapp ssn social security passport account iban id license licence
    teléfono móvil cuenta téléphone portable compte telefon handy konto kontonummer ausweis dni""".split()
)
_COUNTS = frozenset("order invoice isbn issn page pages version model total population vol no figure table chapter item sku usd eur".split())
_BORN = frozenset("born birth birthday dob birthdate geboren geburtsdatum né née naissance nacido nacida nacimiento".split())
_DATED = frozenset("on dated updated version published since until released due date modified".split())
_IBAN = frozenset("AT BE CH CY CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SI SK".split())

_PARTS = re.compile(r"[^\W\d_]+")


@dataclass
class Candidate:
    kind: str
    start: int
    end: int
    text: str
    before: list[str]  # words before it, the nearest last
    after: list[str]
    left: str  # characters next to it
    right: str

    @property
    def words(self) -> list[str]:
        return [word.lower() for word in _PARTS.findall(self.text)]


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[Candidate]:
    """Candidates of the other kinds that do not overlap the spans already taken."""
    out = []
    with_digits = bool(_DIGIT.search(text))
    for kind, pattern in _CANDIDATES.items():
        if kind != "name" and not with_digits:
            continue
        place = 0
        for found in pattern.finditer(text):
            a, b = found.span()
            while place < len(taken) and taken[place][1] <= a:
                place += 1
            if any(x < b and a < y for x, y, _ in taken[place : place + 8]):
                continue
            before = [word.lower() for word in _PARTS.findall(text[max(0, a - 60) : a])][-4:]
            after = [word.lower() for word in _PARTS.findall(text[b : b + 40])][:2]
            out.append(Candidate(kind, a, b, found.group(), before, after, text[max(0, a - 2) : a], text[b : b + 1]))
    return out


# --- labelers --------------------------------------------------------------------

Labeler = Callable[[Candidate], int]


def _vote(yes: bool, no: bool = False) -> int:
    return 1 if yes else -1 if no else 0


def _any(words: list[str], known: frozenset[str]) -> bool:
    return not known.isdisjoint(words)


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return plain[:2] in _IBAN and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


_TELEPHONE = re.compile(r"\(?[0-9]{2,5}\)?[ /-][0-9]{3,4}[ -]?[0-9]{3,5}|[0-9]{3}-[0-9]{2}-[0-9]{4}")


def _possible_birth(text: str) -> bool:
    parts = [int(part) for part in re.split("[./-]", text)]
    year = parts[0] if len(text.split("-")[0]) == 4 else parts[2]
    return 1900 <= year <= 2020 or 20 < year < 100


# Each labeler says 1, personal data; -1, not; or 0, nothing.
LABELERS: dict[str, dict[str, Labeler]] = {
    "name": {
        "form": lambda c: _vote(False, c.left in ("", ". ", "! ", "? ") or c.left.endswith("\n")),
        "given": lambda c: _vote(c.words[0] in _GIVEN),
        "no_name": lambda c: _vote(False, _any(c.words, _NO_NAMES)),
        "title": lambda c: _vote(_any(c.before[-1:], _TITLES), _any(c.before[-1:], _OF_PLACE)),
        "says": lambda c: _vote(_any(c.after[:1], _SAYS)),
    },
    "address": {
        "form": lambda c: _vote(bool(re.search(r"[0-9]{1,4}$", c.text)) and c.words[-1].endswith(("straße", "strasse", "weg", "platz"))),
        "street": lambda c: _vote(_any(c.words, _STREETS)),
        "no_name": lambda c: _vote(False, _any(c.words, _NO_NAMES - _STREETS)),
        "lives": lambda c: _vote(_any(c.before, _LIVES), _any(c.before[-1:], _COUNTS)),
        "town": lambda c: _vote(c.right == ","),
    },
    "number": {
        "form": lambda c: _vote(bool(_TELEPHONE.fullmatch(c.text)) or (c.text[0].isalpha() and _iban(c.text)), "." in c.text or "/" in c.text),
        "plain": lambda c: _vote(False, c.text.isdigit()),
        "calls": lambda c: _vote(_any(c.before, _CALLS)),
        "counts": lambda c: _vote(False, _any(c.before[-2:], _COUNTS)),
        "unit": lambda c: _vote(False, c.right in ("%", "$", "€") or c.left.endswith(("$", "€", "#"))),
    },
    "birth": {
        "form": lambda c: _vote(False, not _possible_birth(c.text)),
        "born": lambda c: _vote(_any(c.before, _BORN)),
        "dated": lambda c: _vote(False, _any(c.before[-1:], _DATED)),
        "person": lambda c: _vote(_any(c.before, _GIVEN)),
    },
}


def votes_of(candidate: Candidate) -> list[int]:
    return [labeler(candidate) for labeler in LABELERS[candidate.kind].values()]


# What the classifier sees: a vote for and one against of each labeler, the form, and hashed neighbours.
_FORM, _NEAR = 12, 32


def features_of(candidate: Candidate, votes: list[int]) -> list[int]:
    out = [0]
    out += [1 + 2 * i + (vote < 0) for i, vote in enumerate(votes) if vote]
    first = 11
    digits = sum(map(str.isdigit, candidate.text))
    out.append(first + min(digits // 3, 5))
    out.append(first + 6 + min(len(candidate.words), 4))
    if " " in candidate.text or "-" in candidate.text:
        out.append(first + 11)
    near = first + _FORM
    for i, words in enumerate((candidate.before[-1:], candidate.after[:1])):
        for word in words:
            out.append(near + i * _NEAR + zlib.crc32(word.encode()) % _NEAR)
    return out


WIDTH = 11 + _FORM + 2 * _NEAR

# --- reliabilities and classifier --------------------------------------------------

# Before any data, a vote is right nine times in ten, an opinion that counts for so many candidates.
_RIGHT, _WEIGHT = 0.9, 20.0
# A candidate on which all labelers are silent is personal data once in ten.
_SILENT = 0.1


@dataclass
class Reliability:
    """How often each labeler of a kind is right when it speaks."""

    right: np.ndarray

    def probability(self, votes: np.ndarray) -> np.ndarray:
        """That candidates with these votes (rows) are personal data."""
        odds = votes @ np.log(self.right / (1 - self.right))
        return np.where((votes != 0).any(axis=1), 1 / (1 + np.exp(-odds)), _SILENT)


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Reliability:
    """Expectation-maximisation over distinct vote combinations (rows) and their counts.

    Most labelers only ever speak for or only against, so silence and the share
    of personal data cannot be told apart from their rates; what can be is how
    often those that speak agree.  A labeler that never meets another keeps the
    opinion from before.
    """
    model = Reliability(np.full(votes.shape[1], _RIGHT))
    for _ in range(rounds):
        own = model.probability(votes)[:, None]
        agrees = np.where(votes > 0, own, 1 - own) * (votes != 0) * counts[:, None]
        spoken = ((votes != 0) * counts[:, None]).sum(axis=0)
        right = (agrees.sum(axis=0) + _RIGHT * _WEIGHT) / (spoken + _WEIGHT)
        done = np.abs(right - model.right).max(initial=0) < 1e-9
        model = Reliability(right)
        if done:
            break
    return model


def logistic(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic model of binary features for probabilities as targets, by Newton's method."""
    x = np.zeros((len(rows), WIDTH))
    for i, row in enumerate(rows):
        x[i, row] = 1
    w = np.zeros(WIDTH)
    ridge = np.full(WIDTH, penalty)
    ridge[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (p - target)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    reliability: dict[str, Reliability] = field(default_factory=dict)
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def probability(self, kind: str, features: list[int]) -> float:
        weights = self.weights.get(kind)
        return 0.0 if weights is None else float(1 / (1 + np.exp(-weights[features].sum())))

    def accepted(self, found: list[tuple[str, int, int, list[int]]]) -> list[tuple[int, int, str]]:
        """Candidates (kind, start, end, features) taken as personal data; of overlapping ones the likeliest."""
        likely = [(self.probability(kind, features), a, b, kind) for kind, a, b, features in found]
        out: list[tuple[int, int, str]] = []
        for _, a, b, kind in sorted((c for c in likely if c[0] >= ACCEPT), key=lambda c: (-c[0], c[1], MORE_KINDS.index(c[3]))):
            if all(b <= x or y <= a for x, y, _ in out):
                out.append((a, b, kind))
        return out


def learned(patterns: list[tuple[str, list[int], int]], sample: list[tuple[str, list[int], list[int], int]]) -> Model:
    """patterns: (kind, votes, count) of the whole corpus; sample: (kind, votes, features, count)."""
    model = Model()
    for kind in MORE_KINDS:
        own = [(votes, n) for name, votes, n in patterns if name == kind]
        rows = [(votes, features, n) for name, votes, features, n in sample if name == kind]
        if not own or not rows:
            continue
        found = reliabilities(np.array([v for v, _ in own]), np.array([n for _, n in own], dtype=float))
        model.reliability[kind] = found
        target = found.probability(np.array([votes for votes, _, _ in rows]))
        # A candidate that occurs very often counts more, but does not drown the others.
        weight = np.log1p(np.array([n for _, _, n in rows], dtype=float))
        model.weights[kind] = logistic([features for _, features, _ in rows], target, weight)
    return model


# --- documents -------------------------------------------------------------------

_FOUND = "struct<kind: string, start: int, end: int, votes: array<int>, features: array<int>>"
_FOUND_TYPE = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("votes", pa.list_(pa.int32())),
            ("features", pa.list_(pa.int32())),
        ]
    )
)


def _found(text: str) -> tuple[list[tuple[int, int, str]], list[dict]]:
    base = base_spans(text)
    out = []
    for candidate in candidates(text, base):
        votes = votes_of(candidate)
        out.append({"kind": candidate.kind, "start": candidate.start, "end": candidate.end, "votes": votes, "features": features_of(candidate, votes)})
    return base, out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_found(text.as_py() or "") for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([spans_text(base) for base, _ in found], pa.string()), pa.array([c for _, c in found], _FOUND_TYPE)],
            ["doc_id", "base", "candidates"],
        )


def scanned(documents: DataFrame) -> DataFrame:
    """doc_id, base (its base spans as text) and candidates of every document row, stored."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(rows.mapInArrow(_scan, f"doc_id long, base string, candidates array<{_FOUND}>"), "personal-scan")


def fit(scan: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from all candidates of a scan; the classifier from at most `sample` distinct ones.

    The combinations of votes are at most 3^5 for each kind.  Without candidates
    of a kind, none is ever accepted.
    """
    counted = stored(
        scan.select(F.explode("candidates").alias("c"))
        .groupBy("c.kind", "c.votes", "c.features")
        .agg(F.count(F.lit(1)).alias("n")),
        "personal-candidates",
    )
    patterns = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m")).collect()
    # About `sample` rows pass by their hash; the limit then makes that a bound.
    key = F.xxhash64("kind", "votes", "features")
    share = min(1.0, 1.2 * sample / max(1, sum(row.m for row in patterns)))
    some = counted.where(F.pmod(key, F.lit(1_000_003)) <= int(share * 1_000_003)).orderBy(key, "kind", "votes", "features").limit(sample)
    rows = sorted(some.collect(), key=lambda row: (row.kind, row.votes, row.features))
    return learned(
        sorted((row.kind, row.votes, row.n) for row in patterns), [(row.kind, row.votes, row.features, row.n) for row in rows]
    )


def _spans_of(text: str) -> list[tuple[int, int, str]]:
    parts = [item.rsplit(":", 2) for item in text.split(",")] if text else []
    return [(int(a), int(b), kind) for kind, a, b in parts]


def _decided(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["base"].to_pylist()
            base = [_spans_of(text) for text in texts]
            out = []
            for own, found in zip(base, batch["candidates"].to_pylist()):
                more = model.accepted([(c["kind"], c["start"], c["end"], c["features"]) for c in found]) if found else []
                out.append(spans_text(sorted(own + more, key=lambda s: (s[0], KINDS.index(s[2])))))
            counts = {f"n_{kind}": pa.array([sum(s[2] == kind for s in own) for own in base], pa.int64()) for kind in BASE_KINDS}
            digests = [hashlib.sha256(text.encode()).hexdigest() for text in texts]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], **counts, "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(out, pa.string())}
            )

    return run


def personal_data(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each document's personal data: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    spans lists kind:start:end in code points of all spans by start and kind,
    base_sha256 is the digest of that list for the four base kinds.  A null text
    counts as empty; repeated rows give a row each and their candidates count as
    often; other columns are not read; an empty table gives no rows.
    """
    scan = scanned(documents)
    counts = ", ".join(f"n_{kind} long" for kind in BASE_KINDS)
    return scan.mapInArrow(_decided(fit(scan, sample)), f"doc_id long, {counts}, base_sha256 string, spans string")


def covered(text: str, model: Model) -> str:
    """The text with every span replaced by its kind in brackets."""
    base, found = _found(text)
    more = model.accepted([(c["kind"], c["start"], c["end"], c["features"]) for c in found])
    out, at = [], 0
    for a, b, kind in sorted(base + more):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def masked(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with personal data replaced by its kind in brackets; all columns stay, a null text stays null."""
    model = fit(scanned(documents), sample)

    @F.pandas_udf("string")
    def cover(texts: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else covered(text, model) for text in texts], dtype=object)

    return documents.withColumn("text", cover("text"))
