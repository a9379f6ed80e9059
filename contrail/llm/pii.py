"""Personal data: fixed patterns, and spans that weakly supervised labelers and a classifier add."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, hashes, small_batches
from contrail.llm.labelled import fit_in_one_task
from contrail.scratch import materialise

RESULT = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "n_added long"
)
BASE_KINDS = ("email", "ip", "card", "phone")

# The base patterns. Look-behinds only spare the engine starts that cannot match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@=:]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of every base span, by start, then kind in the order of ``BASE_KINDS``."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        first = m.start()
        while first > end and (text[first - 1].isascii() and (text[first - 1].isalnum() or text[first - 1] in "._%+-")):
            first -= 1
        if first < m.start():
            out.append((first, m.end(), "email"))
            end = m.end()
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 38:
            digits = re.sub(r"[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


# Candidates and labelers ------------------------------------------------------------------------

# Patterns that are wider than what they look for; the labelers decide.
_CANDIDATES = (
    ("phone", re.compile(r"(?<![\w+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?!\w)")),
    ("id", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("secret", re.compile(r"(?<!\w)(?=[A-Za-z_/+-]{0,63}[0-9])[A-Za-z0-9_/+-]{20,64}={0,2}(?!\w)")),
    ("email", re.compile(r"(?<!\w)\w[\w.+-]{0,63} ?(?:\(at\)|\[at\]) ?\w[\w-]{0,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?\w[\w-]{0,63}){1,4}")),
)
KINDS = (*BASE_KINDS, "id", "iban", "secret")
_BEFORE = {
    "email": ("mail", "contact", "write", "kontakt", "correo"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "contact", "ring"),
    "id": ("ssn", "social", "security", "id", "number"),
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "secret": ("token", "secret", "key", "password", "passwd", "auth", "bearer"),
}
_AGAINST = ("version", "page", "isbn", "figure", "chapter", "section", "doi", "commit", "sha")
_DOMAINS = (".com", ".org", ".net", ".edu", ".gov", ".de", ".fr", ".es", ".info", ".io", ".co")
LABELERS = ("regex", "context", "against", "gazetteer", "edges", "mixture")


def candidates(text: str) -> list[tuple[int, int, str, bool]]:
    """Start, end, kind and whether it is a base span. Others overlap neither these nor each other."""
    if not _TRIGGER.search(text) and "(at)" not in text and "[at]" not in text:
        return []
    out = [(a, b, kind, True) for a, b, kind in base_spans(text)]
    taken = [(a, b) for a, b, _, _ in out]
    for kind, pattern in _CANDIDATES:
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                taken.append(m.span())
                out.append((*m.span(), kind, False))
    return out


def _mixture(span: str) -> float:
    """Bits per character of a span."""
    _, n = np.unique(np.frombuffer(span.encode("utf-8", "replace"), np.uint8), return_counts=True)
    p = n / n.sum()
    return float(-(p * np.log2(p)).sum())


def ballot(text: str, start: int, end: int, kind: str, base: bool) -> int:
    """One base-3 digit per labeler: 0 against, 1 abstains, 2 in favour."""
    span = text[start:end]
    before = text[max(0, start - 32) : start].lower()
    ahead = [w for w in re.split(r"[^\w]+", before) if w][-3:]
    digits = sum(c.isdigit() for c in span)
    known = {
        "email": span.lower().endswith(_DOMAINS),
        "ip": span.startswith(("10.", "192.168.", "172.", "127.")),
        "card": span[:1] in "3456",
        "phone": span.startswith(("+1", "+33", "+34", "+44", "+49")) or "555" in span,
        "id": not span.startswith(("000", "666", "9")),
        "iban": span[:2] in ("DE", "FR", "ES", "GB", "IT", "NL", "BE", "AT", "CH", "PT"),
        "secret": bool(re.fullmatch(r"[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_\w{36}|sk[-_]\w{20,}", span)),
    }[kind]
    outside = text[start - 1 : start] + text[end : end + 1]
    votes = (
        2 if base else 1,
        2 if any(w.startswith(k) for w in ahead for k in _BEFORE[kind]) else 1,
        0 if any(w in _AGAINST for w in ahead) else 1,
        2 if known else 1 if kind in ("ip", "phone", "email") else 0,
        0 if any(c.isalnum() or c in "_/#" for c in outside) else 2 if outside.strip() == "" else 1,
        (2 if digits >= 4 and _mixture(span) > 3.0 else 0) if kind == "secret" else 1,
    )
    return sum(v * 3**k for k, v in enumerate(votes))


def span_features(text: str, start: int, end: int, kind: str, base: bool) -> list[int]:
    """Hashed features of a span: its ballot's votes, outline, length and neighbours."""
    span = text[start:end]
    outline = re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "9", re.sub(r"[a-z]+", "a", span)))[:24]
    ahead = re.split(r"[^\w]+", text[max(0, start - 24) : start].lower())
    code, found = ballot(text, start, end, kind, base), []
    for k, name in enumerate(LABELERS):
        found.append(f"{kind}|{name}|{code // 3**k % 3}")
    found += [
        f"{kind}|shape|{outline}",
        f"{kind}|length|{min(len(span) // 4, 20)}",
        f"{kind}|before|{next((w for w in reversed(ahead) if w), '')}",
        f"{kind}|around|{text[start - 1 : start]}{text[end : end + 1]}",
        f"{kind}",
    ]
    return (hashes(found, len(found)) >> np.uint64(64 - _BITS)).astype(np.int64).tolist()


_BITS = 16

# Label model and classifier ---------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000
    rounds: int = 40
    passes: int = 200
    rate: float = 0.3
    penalty: float = 1e-3
    threshold: float = 0.5


def reliabilities(kinds: np.ndarray, ballots: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """P(personal) for each kind and ballot, by expectation-maximisation.

    A labeler's vote is drawn, given the truth, with probabilities of its own per kind. They start
    from the belief that votes in favour are right three times in four, and are smoothed by that
    belief, so that labels cannot change sides.
    """
    votes = ballots[:, None] // 3 ** np.arange(len(LABELERS)) % 3
    start = np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]])  # truth x vote
    out = np.zeros(len(ballots))
    for kind in np.unique(kinds):
        at = kinds == kind
        v, n = votes[at], counts[at].astype(np.float64)
        table = np.repeat(start[None], len(LABELERS), 0)  # labeler x truth x vote
        prior = 0.5
        for _ in range(rounds):
            logs = [
                np.log(p) + np.log(table[np.arange(len(LABELERS)), truth, v]).sum(1)
                for truth, p in ((0, 1 - prior), (1, prior))
            ]
            belief = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
            weights = np.stack([n * (1 - belief), n * belief])
            prior = float((weights[1].sum() + 1) / (n.sum() + 2))
            for k in range(len(LABELERS)):
                for truth in (0, 1):
                    seen = np.bincount(v[:, k], weights[truth], 3) + 20 * start[truth]
                    table[k, truth] = seen / seen.sum()
        out[at] = belief
    return out


def fit(rows: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression of the posteriors on span features."""
    doc = np.repeat(np.arange(len(rows)), rows["features"].map(len))
    ids, y = np.concatenate(rows["features"].to_list()), rows["posterior"].to_numpy()
    n, size = len(rows), 2**_BITS
    w, g2, b, b2 = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(settings.passes):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(doc, w[ids], n), -50, 50)))
        error = (y - p) / n
        g, gb = np.bincount(ids, error[doc], size) - settings.penalty * w / n, float(error.sum())
        g2, b2 = g2 + g * g, b2 + gb * gb
        w, b = w + settings.rate * g / np.sqrt(g2), b + settings.rate * gb / np.sqrt(b2)
    return w.astype(np.float32), b


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    threshold: float

    def personal(self, text: str, span: tuple) -> bool:
        z = self.bias + float(self.weights[span_features(text, *span)].sum())
        return 1 / (1 + np.exp(-min(max(z, -50.0), 50.0))) >= self.threshold


def train(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> Model:
    """Learns from unlabelled texts: one scan gives the candidates, their ballots and features.

    Ballots are counted over all candidates (at most 3**6 per kind reach the driver); the classifier
    is fitted on at most about ``settings.sample`` of them, drawn at random. Without candidates the
    model adds nothing.
    """
    small_batches(docs.sparkSession)

    def spans(batches):
        for batch in batches:
            found = [(t, c) for t in batch["text"] if t for c in candidates(t)]
            if found:
                yield pd.DataFrame(
                    {
                        "kind": [KINDS.index(c[2]) for _, c in found],
                        "ballot": [ballot(t, *c) for t, c in found],
                        "features": [span_features(t, *c) for t, c in found],
                    }
                )

    found = docs.select(F.col(text).alias("text")).mapInPandas(
        spans, "kind int, ballot int, features array<int>"
    )
    found = materialise(found, "spans")
    counted = found.groupBy("kind", "ballot").count().collect()
    none = np.zeros(2**_BITS, np.float32), -50.0
    if not counted:
        return Model(*none, settings.threshold)
    kinds, ballots, counts = (np.array([r[k] for r in counted], np.int64) for k in range(3))
    belief = reliabilities(kinds, ballots, counts, settings.rounds)
    table = docs.sparkSession.createDataFrame(
        list(zip(kinds.tolist(), ballots.tolist(), belief.tolist(), strict=True)),
        "kind int, ballot int, posterior double",
    )
    share = min(1.0, settings.sample / int(counts.sum()))
    sample = found.filter(F.rand(seed=3) < share).join(F.broadcast(table), ["kind", "ballot"])
    rows = sample.select("posterior", "features")
    return Model(*fit_in_one_task(rows, lambda r: fit(r, settings), none), settings.threshold)


def find(text: str | None, model: Model) -> list[tuple[int, int, str, bool]]:
    """Base spans, and those candidates that the classifier takes for personal data, in order."""
    text = text or ""
    found = [c for c in candidates(text) if c[3] or model.personal(text, c)]
    return sorted(found, key=lambda c: (c[0], KINDS.index(c[2])))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in spans)


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``pii`` as in ``RESULT``; offsets are code points.

    Null and empty texts have no span. The column gets a longer name if there is a ``pii``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.threshold))

    @F.pandas_udf(RESULT)
    def found(texts: pd.Series) -> pd.DataFrame:
        own, rows = Model(*shared.value), []
        for t in texts:
            spans = find(t, own)
            base = [s for s in spans if s[3]]
            counts = [sum(s[2] == k for s in base) for k in BASE_KINDS]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((*counts, digest, _joined(spans), len(spans) - len(base)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return docs.withColumn(fresh(docs, "pii"), found(F.col(text)))


def redact_text(text: str | None, model: Model) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for a, b, kind, _ in find(text, model):
        if b > at:
            out += [text[at : max(a, at)], f"<{kind.upper()}>" if a >= at else ""]
            at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; null stays null. Of spans
    that overlap, the first is named and all are removed."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.threshold))

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        own = Model(*shared.value)
        return pd.Series([redact_text(t, own) for t in texts], dtype=object)

    return docs.withColumn(text, cleaned(F.col(text)))
