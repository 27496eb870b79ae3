"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

One pass over the texts finds the base spans (fixed patterns and checks) and looser candidates, each
with the votes of every labeler (regular expression, checksum, gazetteer, context, form) and a coarse
shape. Votes and shapes are discrete, so counting them natively gives a small table, bounded by the
number of labelers and shapes, that holds all that expectation-maximisation needs: reliabilities come
from every candidate of the corpus. A logistic span classifier is trained on the posteriors and
judges each distinct pattern once. Base spans always stay; other candidates need its consent.

Edge cases: NULL and empty texts have no spans; repeated rows are judged one by one; an empty table,
or one without candidates, trains nothing and gives base spans only; other columns are not looked at.
Texts are scanned whole, in time linear in their length. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import map_arrow, row_schema, small_batches, staged

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "name")
BASE_KINDS = KINDS[:4]
LABELERS = ("pattern", "checksum", "gazetteer", "before", "after", "form")
ACCEPT = 0.9
CONTEXT = 32
EM_ROUNDS = 60
PRIOR = np.array([4.0, 1.0])  # right and wrong votes that each labeler starts with
# More distinct (kind, votes, shape) patterns than this cannot arise: 7 kinds, 3 votes by 6 labelers,
# 5 shapes by 4 lengths.
MOST_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 20

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Candidates: digit groups with up to two separators between, standing alone.
_GROUPS = re.compile(r"(?<![A-Za-z0-9])\(?[0-9]++(?:[\x20().,/:-]{1,2}[0-9]++)*+(?![A-Za-z0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_HIDDEN = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}){1,8}"
)
_TITLES = ("Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame")
_NAME = re.compile(r"\b(?:%s)\.?\x20([A-Z][a-zà-ÿ]{1,30}(?:\x20[A-Z][a-zà-ÿ]{1,30})?)" % "|".join(_TITLES))

# Gazetteers (fixed values).
_TOP_LEVELS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at"}
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "352", "353", "358", "420", "421")
_GIVEN = {"john", "mary", "james", "anna", "peter", "paul", "maria", "thomas", "michael", "laura", "hans", "pierre", "juan", "carlos", "claire", "julia", "robert", "david", "sarah", "emma"}
_FOR = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "cell"),
    "iban": ("iban", "konto", "account", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "name": ("name", "dear", "sincerely", "by"),
}
_AGAINST = ("version", "ver.", "order", "isbn", "invoice", "sku", "chapter", "section", "fig", "http", "doi")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        d = int(digit) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, ordered by kind, then start."""
    found = []
    at, low = text.find("@"), 0
    while at >= 0:
        before = text[low:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            found.append((0, at - local, domain.end()))
        low = domain.end() if domain else at + 1
        at = text.find("@", low)
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if m[1] and _small_parts(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _only_digits(m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_only_digits(m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def _loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that touch no base span, and no other candidate before them."""
    found = []
    if _DIGIT.search(text):
        found += [(4, *m.span()) for m in _IBAN.finditer(text)]
        for m in _GROUPS.finditer(text):
            n, parts = len(_only_digits(m[0])), re.findall("[0-9]+", m[0])
            if len(parts) == 4 and re.fullmatch(r"[0-9]+(\.[0-9]+){3}", m[0]):
                kind = 1
            elif [len(p) for p in parts] == [3, 2, 4]:
                kind = 5
            elif 13 <= n <= 19:
                kind = 2
            elif 8 <= n <= 12 and (len(parts) > 1 or m[0][0] == "0"):
                kind = 3
            else:
                continue
            found.append((kind, *m.span()))
    if any(mark in text for mark in ("(at)", "[at]")):
        found += [(0, *m.span()) for m in _HIDDEN.finditer(text)]
    if any(title in text for title in _TITLES):
        found += [(6, *m.span(1)) for m in _NAME.finditer(text)]
    kept, taken, edge = [], sorted((s, e) for _, s, e in base), 0
    i = 0
    for kind, start, end in sorted(found, key=lambda x: (x[1], x[2])):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start >= edge and not any(s < end and e > start for s, e in taken[i : i + 8]):
            kept.append((kind, start, end))
            edge = end
    return kept


def _iban_ok(span: str) -> bool:
    s = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _votes(text: str, kind: int, start: int, end: int, base: bool) -> str:
    """One of + - . (abstains) by each labeler."""
    name, span = KINDS[kind], text[start:end]
    digits = _only_digits(span)
    pattern = "+" if base else "-" if name in BASE_KINDS else "."
    checks = {
        "ip": lambda: _small_parts(span),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
        "iban": lambda: _iban_ok(span),
        "ssn": lambda: digits[:3] not in ("000", "666") and digits[0] != "9",
    }
    checksum = "." if name not in checks else "+" if checks[name]() else "-"
    lists = {
        "email": lambda: re.split(r"[.\s)\]]", span.lower())[-1] in _TOP_LEVELS,
        "card": lambda: digits[0] in "3456",
        "phone": lambda: span[0] == "+" and digits.startswith(_CALLING),
        "name": lambda: span.split(" ")[0].lower() in _GIVEN,
    }
    gazetteer = "." if name not in lists else "+" if lists[name]() else "-"

    def context(part: str) -> str:
        part = part.lower()
        if any(word in part for word in _FOR[name]):
            return "+"
        return "-" if any(word in part for word in _AGAINST) else "."

    before = context(text[max(0, start - CONTEXT) : start])
    after = context(text[end : end + CONTEXT])
    plain = len(set(digits)) <= 2 and len(digits) >= 8 or digits in "01234567890123456789"
    form = "." if not digits else "-" if plain and len(digits) > 3 else "+"
    return pattern + checksum + gazetteer + before + after + form


def _shape(span: str) -> str:
    """Coarse form: what separates its parts, and how long it is."""
    marks = {c for c in span if not c.isalnum()}
    kind = "n" if not marks else "s" if marks == {" "} else "d" if marks == {"."} else "h" if marks == {"-"} else "m"
    return kind + str(min(3, len(span) // 8))


@dataclass
class SpanModel:
    """What the labelers are worth and what the classifier thinks of each pattern."""

    reliability: dict[str, dict[str, float]]
    weights: dict[str, float]
    probability: dict[tuple[int, str, str], float]

    def accepts(self, kind: int, votes: str, shape: str) -> bool:
        return self.probability.get((kind, votes, shape), 0.0) >= ACCEPT


def _features(kind: int, votes: str, shape: str) -> list[str]:
    signs = [f"{name}{v}" for name, v in zip(LABELERS, votes) if v != "."]
    return ["bias", f"kind={KINDS[kind]}", f"shape={shape[0]}", f"length={shape[1]}", *signs]


def fit(patterns: list[tuple[int, str, str, int]]) -> SpanModel:
    """EM for the labelers' reliabilities, then the span classifier, on counted patterns.

    The start is the majority vote. Each labeler has its own rate of + among its votes on true and on
    false spans; abstaining says nothing, as many labelers know only some kinds. The share of true
    spans is per kind. ``PRIOR`` counts, by which labelers are rather right than wrong, smooth the
    rates and tell the two classes apart where a corpus has spans of one class only.
    """
    if not patterns:
        return SpanModel({}, {}, {})
    count = np.array([p[3] for p in patterns], dtype=float)
    votes = np.array([["+-.".index(v) for v in p[1]] for p in patterns])
    kinds = np.array([p[0] for p in patterns])
    balance = (votes == 0).sum(1) - (votes == 1).sum(1)
    truth = 1 / (1 + np.exp(-1.5 * balance))
    for _ in range(EM_ROUNDS):
        log = np.zeros((len(patterns), 2))
        rates = np.zeros((2, len(LABELERS), 2))
        for y, weight in enumerate((count * (1 - truth), count * truth)):
            for j in range(len(LABELERS)):
                seen = np.bincount(votes[:, j], weights=weight, minlength=3)[:2]
                seen += PRIOR if y else PRIOR[::-1]
                rates[y, j] = seen / seen.sum()
                log[:, y] += np.append(np.log(rates[y, j]), 0.0)[votes[:, j]]
            share = np.array([1 + weight[kinds == k].sum() for k in range(len(KINDS))])
            both = np.array([2 + count[kinds == k].sum() for k in range(len(KINDS))])
            log[:, y] += np.log(share / both)[kinds]
        log[:, 1] = np.clip(log[:, 1] - log[:, 0], -30, 30)
        truth = 1 / (1 + np.exp(-log[:, 1]))
    reliability = {
        name: {"true_positive": float(rates[1, j, 0]), "false_positive": float(rates[0, j, 0]),
               "true_negative": float(rates[0, j, 1]), "false_negative": float(rates[1, j, 1])}
        for j, name in enumerate(LABELERS)
    }

    rows = [_features(*p[:3]) for p in patterns]
    names = sorted({f for row in rows for f in row})
    x = np.array([[f in row for f in names] for row in rows], dtype=float)
    share = count / count.sum()
    weights = np.zeros(len(names))
    for _ in range(30):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (p - truth)) + 1e-4 * weights
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(names))
        weights -= np.linalg.solve(curve, slope)
    p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
    return SpanModel(
        reliability,
        dict(zip(names, map(float, weights))),
        {row[:3]: float(q) for row, q in zip(patterns, p)},
    )


_SPAN = pa.struct(
    [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
     ("votes", pa.string()), ("shape", pa.string())]
)
_SPAN_SQL = "array<struct<kind:int,start:int,end:int,base:boolean,votes:string,shape:string>>"


def candidates(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """``keep`` as ``row``, and every base span and candidate with its votes as ``spans``.

    Where ``keep`` is a struct that holds the text, name it ``keep.text``: it then travels once.
    """
    inner = text.removeprefix(f"{keep}.").strip("`") if text.startswith(f"{keep}.") else None
    narrow = docs.select(F.col(keep).alias("row"), *([] if inner else [F.col(text).alias("text")]))
    place = narrow.schema["row"].dataType.names.index(inner) if inner else None

    def scan(batches):
        for batch in small_batches(batches):
            out = []
            texts = pc.struct_field(batch.column("row"), [place]) if inner else batch.column("text")
            for t in texts.to_pylist():
                spans = []
                if t:
                    base = base_spans(t)
                    loose = _loose_spans(t, base)
                    for is_base, found in ((True, base), (False, loose)):
                        for kind, start, end in found:
                            votes = _votes(t, kind, start, end, is_base)
                            spans.append((kind, start, end, is_base, votes, _shape(t[start:end])))
                out.append([dict(zip(("kind", "start", "end", "base", "votes", "shape"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.list_(_SPAN))], ["row", "spans"]
            )

    return map_arrow(narrow, scan, row_schema(narrow.schema["row"], f"spans {_SPAN_SQL}"))


def train(found: DataFrame) -> SpanModel:
    """Count the patterns of all candidates, on Spark, and fit on the counts."""
    counted = (
        found.select(F.explode("spans").alias("s"))
        .groupBy("s.kind", "s.votes", "s.shape")
        .agg(F.count("*").alias("n"))
    )
    patterns = sorted(tuple(row) for row in counted.collect())
    assert len(patterns) <= MOST_PATTERNS
    return fit(patterns)


def _final(spans: list[dict], model: SpanModel) -> list[dict]:
    """Base spans and those that the model accepts, in order of kind and start."""
    kept = [s for s in spans if s["base"] or model.accepts(s["kind"], s["votes"], s["shape"])]
    return sorted(kept, key=lambda s: (s["kind"], s["start"], s["end"]))


def find_personal_data(
    docs: DataFrame, text: str = "text", keep: str = "doc_id"
) -> tuple[DataFrame, SpanModel]:
    """``row`` (the kept column) and its final ``spans``, in order of kind and start; the model."""
    found = staged(candidates(docs, text, keep))
    model = train(found)

    def judge(batches):
        for batch in small_batches(batches):
            out = [_final(spans, model) for spans in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.list_(_SPAN))], ["row", "spans"]
            )

    return map_arrow(found, judge, row_schema(found.schema["row"], f"spans {_SPAN_SQL}")), model


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text, per row."""

    def listed(only_base: bool):
        spans = F.filter("spans", lambda s: s["base"]) if only_base else F.col("spans")
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
            ),
            ",",
        )

    def base_count(kind: int):
        hits = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(hits).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        F.col("row").alias("doc_id"),
        *[base_count(k) for k in range(len(BASE_KINDS))],
        F.sha2(listed(True), 256).alias("base_sha256"),
        listed(False).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The documents with personal data replaced by ``<KIND>``; other columns as they came.

    Overlapping spans become one, named after the first. ``length`` optionally names a column that
    holds the text's number of characters and is brought up to date.
    """
    found = staged(candidates(docs.select(F.struct("*").alias("row")), f"row.`{text}`", "row"))
    model = train(found.select("spans"))
    columns = docs.columns

    def mask(batches):
        for batch in small_batches(batches):
            out = []
            texts = pc.struct_field(batch.column("row"), [columns.index(text)]).to_pylist()
            for t, spans in zip(texts, batch.column("spans").to_pylist()):
                if spans := _final(spans, model):
                    parts, at = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= at:
                            parts += [t[at : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
                        at = max(at, s["end"])
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.string())], ["row", "masked"]
            )

    masked = map_arrow(found, mask, row_schema(found.schema["row"], "masked string"))
    new = {text: F.col("masked")}
    if length:
        new[length] = F.when(F.col("masked").isNull(), F.col(f"row.`{length}`")).otherwise(
            F.length("masked").cast(docs.schema[length].dataType)
        )
    return masked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def sha256_of(spans: list[tuple[int, int, int]]) -> str:
    """The digest of base spans, as the query derives it."""
    listed = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
    return hashlib.sha256(listed.encode()).hexdigest()
