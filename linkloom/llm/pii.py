"""Personal data found by weak supervision.

Spans that could be personal data are taken from every text by broad patterns. On each span
labelers vote for or against, or abstain: strict patterns and checksums, gazetteers, and the
words around. Votes are counted over all documents; expectation-maximisation estimates, by kind
of span and without any true label, how often each labeler votes for true and for false spans.
The posteriors, again over all documents, train the final classifier, a logistic regression on
features of the span and its votes, which judges spans that labelers contradict each other on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from linkloom.llm.common import release, slices, text_or_empty

KINDS = ["EMAIL", "IP", "PHONE", "CARD", "SECRET", "ID_NUMBER", "ADDRESS", "BIRTH_DATE", "NAME"]
LABELERS = ["pattern", "checksum", "gazetteer", "context", "shape", "counter"]
SCHEMA = "doc_id long, span_start long, span_end long, kind string, probability double, is_pii boolean"

_FIRST_NAMES = (
    "Adam Agnes Alan Albert Alejandro Alexander Alice Amanda Ana Andrea Andrew Angela Anja Anna Antoine Antonio Barbara Benjamin Bernard Brian Camille Carlos Carmen Caroline Catherine Charles Charlotte "
    "Christine Christopher Claire Claudia Daniel David Deborah Dennis Diana Diego Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Fernando Francisco François Frank Gabriel George Gerhard Hannah Hans "
    "Harold Heather Heinrich Helen Helga Henri Ingrid Isabel Jack Jacob Jacqueline James Janet Javier Jean Jennifer Jessica Joan John Jonathan Jorge José Joseph Joshua Juan Julia Julie Jürgen Karen Karl "
    "Katherine Kenneth Kevin Klaus Laura Lisa Louis Lucas Luis Manuel Margaret María Maria Marie Martin Martina Mary Matthew Megan Melissa Michael Michelle Miguel Monika Nancy Nathalie Nicholas Nicolas Olivia "
    "Pablo Pamela Patricia Patrick Paul Pedro Peter Philippe Pierre Rachel Raymond Rebecca Richard Robert Ronald Rosa Ruth Samuel Sandra Sarah Scott Sergio Sophie Stefan Stephanie Stephen Steven Susan Susanne "
    "Teresa Theresa Thomas Timothy Uwe Victoria Virginia Walter Werner William Wolfgang"
).split()
_TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Monsieur Madame".split()
_STREETS = "Street Avenue Road Boulevard Lane Drive Court Square Place St Ave Rd Blvd Ln Ct".split()
_FIRST = "|".join(_FIRST_NAMES)

#: A text without any of these has no candidate. Read by RE2, in time that is linear in the text.
HINT = r"[0-9@]|AKIA|gh[pousr]_|sk_|xox|AIza|eyJ|(?i:token|secret|passw|api.?key|access.?key)" + rf"|(?:{_FIRST}|(?:{'|'.join(_TITLES)})\.?) [A-Z]"
_LOCAL = r"[A-Za-z0-9._%+\-]"
_CANDIDATE = re.compile(
    r"(?P<SECRET>(?i:(?:token|secret(?:[_-]?key)?|password|passwd|api[_-]?key|access[_-]?key)\b)[\"']?\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9_\-+/=.]{8,})[\"']?)"
    r"|(?P<KEY>\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9\-]{10,}|AIza[0-9A-Za-z_\-]{35}|(?<![\w\-])eyJ[\w\-]{10,}\.[\w\-]{10,}\.[\w\-]+)(?![A-Za-z0-9]))"
    # a local part has 64 characters at most; no backtracking, so that a long unbroken run takes time in proportion
    r"|(?P<EMAIL>(?:(?<![A-Za-z0-9._%+\-])|(?<=[A-Za-z0-9._%+\-]{64}))[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9.\-]+[A-Za-z0-9])"
    r"|(?P<IP>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<CARD>(?<![\w+])(?:\d{4}(?:[ .\-]?\d{4}){2}[ .\-]?\d{1,7}|\d{4}[ .\-]?\d{6}[ .\-]?\d{5})(?!\w))"
    r"|(?P<BIRTH_DATE>(?i:\b(?:born|dob|birth|birthday|birthdate|geboren|naissance|nacid[oa]))\b[^\d\n]{0,24}(?P<date>\d{1,4}(?P<slash>[./\-])\d{1,2}(?P=slash)\d{1,4})(?!\w))"
    r"|(?P<PHONE>(?<![\w+])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}"
    r"|(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{6,8}"
    r"|\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{1,4}(?P<sep>[ .\-])\d{2,4}(?:(?P=sep)\d{2,4}){1,4}"
    r"|\+\d{1,3}[ .\-]?\d{2,5}[ .\-]\d{4,9}|\+\d{8,15}|0\d(?P<pair>[ .\-])\d{2}(?:(?P=pair)\d{2}){3})(?!\w|[.\-]\d))"
    r"|(?P<ID_NUMBER>(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)|(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    rf"|(?P<ADDRESS>(?<![\w.])\d{{1,5}}[a-z]? (?:[A-Z][\w'\-]{{0,30}} ){{1,4}}(?:{'|'.join(_STREETS)})\b)"
    rf"|(?P<NAME>\b(?:(?:{_FIRST})|(?:{'|'.join(_TITLES)})\.?) (?:[A-Z]\. )?[A-Z][^\W\d_]{{1,30}}(?:[ \-][A-Z][^\W\d_]{{1,30}})?)"
)
_TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io dev app co uk de fr es it nl be ch at pl se no fi dk pt ie us ca mx br ar cl au nz jp cn in ru eu ai me tv".split())
_COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_CONTEXT = {
    "EMAIL": frozenset("email mail e-mail contact write address correo courriel".split()),
    "IP": frozenset("ip host server address client connection login from".split()),
    "PHONE": frozenset("phone call tel telephone mobile fax cell telefon teléfono".split()),
    "CARD": frozenset("card visa mastercard credit payment karte tarjeta carte".split()),
    "SECRET": frozenset("token secret password passwd api_key apikey key".split()),
    "ID_NUMBER": frozenset("ssn social security iban account konto cuenta".split()),
    "ADDRESS": frozenset("address lives live at ship deliver home resident residence".split()),
    "BIRTH_DATE": frozenset("born dob birth birthday birthdate date geboren naissance nacido nacida".split()),
    "NAME": frozenset("name contact dear regards signed author customer patient employee client by from mr mrs ms".split()),
}
_NUMBERED = frozenset("version v ver release build isbn issn section chapter figure table page example firmware kernel serial model part revision".split())
#: Words before a span (or right after a name) that speak against it.
_AGAINST = {k: _NUMBERED for k in KINDS} | {"SECRET": frozenset("example placeholder dummy".split()), "NAME": frozenset("street avenue road university college school institute hospital airport park prize theorem inc ltd llc gmbh company foundation museum bridge saint".split())}
_PLACEHOLDERS = frozenset("changeme password undefined required your_token your_password placeholder example".split())
_KEY_STARTS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk_live_", "sk_test_", "xox", "AIza", "eyJ")
_NEAR = re.compile(r"[^\W_][\w\-]*")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of spans that could be personal data; they don't overlap."""
    out = []
    for m in _CANDIDATE.finditer(text):
        kind = "SECRET" if m["KEY"] is not None else next(k for k in KINDS if m[k] is not None)
        start, end = m.span("value") if m["value"] is not None else m.span("date") if m["date"] is not None else m.span()
        out.append((start, end, kind))
    return out


def votes(text: str, start: int, end: int, kind: str) -> list[int]:
    """One vote for each of LABELERS: 1 for, -1 against, 0 abstains."""
    s = text[start:end]
    digits = re.sub(r"\D", "", s)
    before = [w.lower() for w in _NEAR.findall(text[max(0, start - 48) : start])][-4:]
    after = [w.lower() for w in _NEAR.findall(text[end : end + 32])][:2]
    pattern = checksum = gazetteer = shape = counter = 0
    if kind == "EMAIL":
        local, _, domain = s.rpartition("@")
        pattern = 1 if re.fullmatch(r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9])?@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}", s) else -1
        gazetteer = 1 if domain.rpartition(".")[2].lower() in _TOP_DOMAINS and "." in domain else -1
        shape = 1 if len(local) <= 64 and len(domain) <= 253 and ".." not in s else -1
    elif kind == "IP":
        parts = [int(p) for p in s.split(".")]
        pattern = 1 if all(p < 256 for p in parts) else -1
        # blocks that name no one: of the machine itself, of usual private networks, of none
        gazetteer = counter = -1 if parts[:2] in ([127, 0], [10, 0], [192, 168], [169, 254], [0, 0]) or parts == [255] * 4 else 0
        shape = -1 if any(len(p) > 1 and p[0] == "0" for p in s.split(".")) else 1
    elif kind == "PHONE":
        pattern = 1 if re.fullmatch(r"\+?\d{0,3}[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]\d{4}|\+\d[\d ().\-]+", s) else 0
        code = re.match(r"\+(\d{1,3})", s)
        gazetteer = 0 if code is None else 1 if any(code[1].startswith(c) for c in _COUNTRY_CODES) else -1
        shape = 1 if 9 <= len(digits) <= 15 else -1
    elif kind == "CARD":
        pattern = 1 if 13 <= len(digits) <= 19 else -1
        checksum = 1 if _luhn(digits) else -1
        counter = min(checksum, 0)  # every card has a right check digit
        gazetteer = 1 if digits[0] in "3456" or digits[:2] in ("22", "23", "24", "25", "26", "27") else -1
        shape = 1 if len(digits) in (15, 16) and len(set(digits)) > 3 else -1
    elif kind == "SECRET":
        pattern = 1 if re.fullmatch(r"[0-9a-fA-F]{16,}|[A-Za-z0-9_\-+/=.]{20,}", s) else 0
        gazetteer = 1 if s.startswith(_KEY_STARTS) else 0
        counter = -1 if s.lower() in _PLACEHOLDERS or len(set(s)) < 4 else 0
        shape = 1 if digits and re.search(r"[A-Za-z]", s) and len(set(s)) >= 6 else -1
    elif kind == "ADDRESS":
        pattern = 1 if s[0] != "0" else -1
        gazetteer = 1 if s.rsplit(" ", 1)[1] in _STREETS[:9] else 0
        shape = 1 if len(s.split()) <= 5 else -1
    elif kind == "BIRTH_DATE":
        parts = sorted(int(x) for x in re.split(r"[./\-]", s))
        pattern = 1 if 1 <= parts[0] <= 31 and 1 <= parts[1] <= 31 and min(parts[:2]) <= 12 else -1
        shape = 1 if 1900 <= parts[2] <= 2035 or parts[2] < 100 else -1
    elif kind == "NAME":
        first = s.split(" ", 1)[0].rstrip(".")
        pattern = 1 if all(x[0].isupper() and not x[1:].isupper() for x in s.replace("-", " ").split() if len(x) > 2) else -1
        gazetteer = -1 if set(s.lower().split()) & _AGAINST["NAME"] else 1 if first in _FIRST_NAMES else 0
        shape = -1 if text[end : end + 1].isalnum() or re.match(r" [A-Z]", text[end : end + 2]) else 1
        if first in _TITLES:
            before.append("mr")
    else:
        if "-" in s:
            pattern = 1 if not s.startswith(("000", "666", "9")) and s[4:6] != "00" and not s.endswith("0000") else -1
            shape = 1 if len(set(digits)) > 2 else -1
        else:
            checksum = 1 if _iban(s) else -1
            pattern = 1 if 15 <= len(s.replace(" ", "")) <= 34 else -1
            shape = 1 if digits and len(digits) * 2 > len(s) else -1
    around = set(before) | set(after)
    if kind == "SECRET":  # names such as DB_PASSWORD
        around |= {part for w in around for part in re.split("[_-]", w)}
    context = 1 if around & _CONTEXT[kind] else 0
    if (set(before[-2:]) | (set(after) if kind == "NAME" else set())) & _AGAINST[kind] or kind == "NAME" and set(s.lower().split()) & _AGAINST[kind]:
        counter = -1
    return [pattern, checksum, gazetteer, context, shape, counter]


def bits_of(text: str, start: int, end: int) -> int:
    """Features of the span itself, as bits: length in four steps, share of digits in four, neighbours that are word characters, quotes."""
    s = text[start:end]
    length = min(3, len(s).bit_length() - 3) if len(s) > 7 else 0
    digits = min(3, 4 * sum(c.isdigit() for c in s) // max(1, len(s)))
    left = start > 0 and (text[start - 1].isalnum())
    right = end < len(text) and (text[end].isalnum())
    quoted = start > 0 and text[start - 1] in "\"'"
    return length | digits << 2 | left << 4 | right << 5 | quoted << 6


def _code(v: list[int]) -> int:
    return sum((x + 1) * 3**k for k, x in enumerate(v))


def _decode(codes: np.ndarray) -> np.ndarray:
    return np.stack([(codes // 3**k) % 3 - 1 for k in range(len(LABELERS))], axis=1) if len(codes) else np.zeros((0, len(LABELERS)), np.int64)


def _inputs(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    v = _decode(codes)
    parts = [np.ones((len(codes), 1)), v == 1, v == -1]
    for shift, n in ((0, 4), (2, 4)):
        parts.append(((bits >> shift) & 3)[:, None] == np.arange(n))
    parts.append(np.stack([(bits >> k) & 1 for k in (4, 5, 6)], axis=1))
    return np.concatenate([p.astype(np.float64) for p in parts], axis=1)


#: Before any data: how often a labeler that votes at all votes for a true and for a false span. The last one only votes against, or abstains.
_FOR_TRUE = np.array([0.9, 0.99, 0.9, 0.95, 0.9, 0.995])
_FOR_FALSE = np.array([0.5, 0.1, 0.4, 0.4, 0.5, 0.4])
_PRIOR_VOTES = 10.0


def estimate(codes: np.ndarray, counts: np.ndarray, anchor: float = 0.25, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation for one kind: (posteriors, share of true spans, a row for each labeler of how often it votes for true and for false spans).

    Labelers are taken as independent given the truth, each with a rate for true spans and one
    for false ones. What is taken for granted before any data weighs ten votes and ``anchor``
    times the spans, so that a few false spans among many true ones aren't made true by
    likelihood alone. A labeler can prove to say nothing,
    but never the contrary of its vote. Where the last labeler abstains it counts as a vote for.
    """
    v = _decode(codes).astype(np.float64)
    pro, con = (v == 1).astype(np.float64), (v == -1).astype(np.float64)
    pro[:, -1] = v[:, -1] == 0
    rates, share = np.stack([_FOR_TRUE, _FOR_FALSE], axis=1), 0.5
    posterior = np.full(len(codes), 0.5)
    total = counts.sum()
    prior = _PRIOR_VOTES + anchor * total
    for _ in range(rounds):
        odds = pro @ np.log(rates[:, 0] / rates[:, 1]) + con @ np.log((1 - rates[:, 0]) / (1 - rates[:, 1])) + np.log(share / (1 - share))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        new = np.empty_like(rates)
        for k, (weight, before) in enumerate(((posterior * counts, _FOR_TRUE), ((1 - posterior) * counts, _FOR_FALSE))):
            new[:, k] = (weight @ pro + prior * before) / (weight @ (pro + con) + prior)
        new = np.clip(new, 1e-6, 1 - 1e-6)
        new[:, 1] = np.minimum(new[:, 1], new[:, 0])
        share = float(np.clip((posterior @ counts + 1 + anchor * total / 2) / (total * (1 + anchor) + 2), 0.02, 0.98))
        done = np.abs(new - rates).max() < 1e-7
        rates = new
        if done:
            break
    return posterior, share, rates


def regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Logistic regression on probabilistic labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - l2 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w)), g)
        w += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


@dataclass
class Model:
    """Weights of the final classifier by kind, and what expectation-maximisation found: the share of true spans, and each labeler's rates of votes for true and false ones."""

    weights: dict[str, np.ndarray]
    shares: dict[str, float]
    rates: dict[str, dict[str, list[float]]]

    def probability(self, kind: str, votes_code: int, bits: int) -> float:
        key = (kind, votes_code, bits)
        known = self.__dict__.setdefault("_known", {})
        if key not in known:
            w = self.weights.get(kind)
            z = float(_inputs(np.array([votes_code]), np.array([bits]))[0] @ w) if w is not None else 0.0
            known[key] = 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))
        return known[key]


def fit(counted: list[tuple[str, int, int, int]]) -> Model:
    """Fits the model to (kind, votes, bits, number of spans)."""
    model = Model({}, {}, {})
    for kind in KINDS:
        rows = sorted((v, b, n) for k, v, b, n in counted if k == kind)
        if not rows:
            continue
        v, b, n = (np.array(c) for c in zip(*rows))
        posterior, share, rates = estimate(v, n.astype(np.float64))
        model.shares[kind], model.rates[kind] = share, dict(zip(LABELERS, rates.tolist()))
        model.weights[kind] = regress(_inputs(v, b), posterior, n.astype(np.float64))
    return model


def _hinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the rows that can have a candidate."""
    for batch in batches:
        for part in slices(batch):
            kept = part.filter(pc.match_substring_regex(part.column("text"), HINT))
            if kept.num_rows:
                yield kept
        release()


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each (kind, votes, bits) occurs in a slice."""
    for part in _hinted(batches):
        count: dict[tuple[str, int, int], int] = {}
        for text in part.column("text").to_pylist():
            for start, end, kind in candidates(text):
                key = (kind, _code(votes(text, start, end, kind)), bits_of(text, start, end))
                count[key] = count.get(key, 0) + 1
        if count:
            kinds, codes, bits = zip(*count)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(codes, pa.int64()), pa.array(bits, pa.int64()), pa.array(list(count.values()), pa.int64())], ["kind", "votes", "bits", "n"])


def train(docs: DataFrame) -> Model:
    """Votes of all documents, counted by what the classifier can tell apart, then the two fits. The table of counts is bounded by the numbers of kinds, votes and features."""
    texts = docs.select(text_or_empty(docs["text"]).alias("text"))
    counted = texts.mapInArrow(_patterns, "kind string, votes long, bits long, n long").groupBy("kind", "votes", "bits").agg(F.sum("n").alias("n"))
    return fit([tuple(r) for r in counted.collect()])


def find(text: str, model: Model) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, probability) of each candidate span."""
    return [(s, e, k, model.probability(k, _code(votes(text, s, e, k)), bits_of(text, s, e))) for s, e, k in candidates(text)]


def pii_spans(docs: DataFrame, *, accept: float = 0.5) -> DataFrame:
    """(doc_id, span_start, span_end, kind, probability, is_pii) of every candidate span.

    Positions count characters of the text. ``is_pii`` if the probability, before rounding, is
    at least ``accept``. The model is fitted to the same documents, all of them. Null and empty
    texts have no span; long texts are read whole; repeated rows count and are reported each; a
    null doc_id stays null; an empty table, or one without candidates, gives an empty result;
    other columns are ignored.
    """
    model = train(docs)
    fields = pa.schema([("doc_id", pa.int64()), ("span_start", pa.int64()), ("span_end", pa.int64()), ("kind", pa.string()), ("probability", pa.float64()), ("is_pii", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _hinted(batches):
            rows = [(i, s, e, k, round(p, 6), p >= accept) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for s, e, k, p in find(t, model)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs["text"]).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def masked(text: Column, model: Model, accept: float = 0.5) -> Column:
    """The text with each span of personal data replaced by its kind in brackets. Null stays null."""

    @F.arrow_udf(StringType())
    def run(t: pa.Array) -> pa.Array:
        hinted = pc.fill_null(pc.match_substring_regex(t, HINT), False)
        out = []
        for x in t.filter(hinted).to_pylist():
            for start, end, kind, p in reversed(find(x, model)):
                if p >= accept:
                    x = f"{x[:start]}[{kind}]{x[end:]}"
            out.append(x)
        changed = pc.replace_with_mask(t, hinted, pa.array(out, t.type))
        release()
        return changed

    return run(text)


def mask_pii(docs: DataFrame, *, accept: float = 0.5) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars``, if there, counted again; the same rows and columns.

    The model is fitted to the same documents. Null texts stay null and have a null ``n_chars``;
    empty texts stay empty; repeated rows, null doc_ids and all other columns stay as they are;
    an empty table stays empty.
    """
    model = train(docs)
    kind = docs.schema["text"].dataType
    changed = docs.withColumn("text", masked(docs["text"].cast("string"), model, accept).cast(kind))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
