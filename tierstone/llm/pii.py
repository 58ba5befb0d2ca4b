"""Personal data: base patterns, and more spans by weakly supervised labelers."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import scratch, texts

#: Kinds in the order that breaks ties of the start; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "secret", "account", "contact", "handle", "national", "address", "person")
BASE_KINDS = KINDS[:4]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]*")
# A run of digits is taken whole or not at all, so starts within a run need no trial.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Wide candidates of the labelers.
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CONTACT = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")
HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])@[A-Za-z][A-Za-z0-9_]{2,}+(?![.@])")
NATIONAL = re.compile(r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[12] ?[0-9]{2} ?[01][0-9] ?[0-9AB]{2} ?[0-9]{3} ?[0-9]{3}(?: ?[0-9]{2})?|[0-9]{8}-?[A-Z]|[A-Z]{2}[0-9]{6}[A-D])(?![0-9A-Za-z-])")
CAPITAL = r"(?:[A-Z]|[À-ÖØ-Þ])[\w'’-]+"
#: Kinds of streets, before the name or after it, and titles before a person's name.
STREETS_AFTER = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Boulevard", "Blvd", "Drive", "Court", "Square", "Terrace")
STREETS_BEFORE = ("rue", "avenue", "boulevard", "place", "calle", "avenida", "via", "piazza")
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame", "Señor", "Señora")
ADDRESS = re.compile(
    r"(?<![\w.-])(?:[0-9]{1,5}[A-Za-z]? (?:" + CAPITAL + r" ){1,3}(?:" + "|".join(STREETS_AFTER) + r")\b\.?"
    r"|[0-9]{1,5},? (?:" + "|".join(STREETS_BEFORE) + r") (?:d[eu]s? |de la |del )?" + CAPITAL + r"(?: " + CAPITAL + r"){0,2}"
    r"|" + CAPITAL + r"(?:straße|strasse|weg|gasse|platz|allee) [0-9]{1,4}[a-z]?)(?!\w)"
)
#: Gazetteers, by kind: words that stand near data of the kind, and words that speak against it.
NEAR = {
    "secret": ("token", "secret", "password", "passwd", "passphrase", "pwd", "api", "apikey", "key", "bearer", "auth", "credential"),
    "account": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "contact": ("call", "phone", "tel", "telephone", "mobile", "fax", "contact", "telefon", "teléfono", "téléphone"),
    "handle": ("follow", "twitter", "instagram", "contact", "telegram", "dm"),
    "national": ("ssn", "social", "security", "passport", "national", "identity", "nif", "dni", "nino", "insee", "taxpayer"),
    "address": ("address", "live", "lives", "living", "deliver", "ship", "adresse", "dirección", "wohnt", "habite", "resides", "mail"),
    "person": ("name", "named", "contact", "dear", "signed", "patient", "customer", "employee", "nom", "nombre", "regards", "sincerely"),
}
# Capitalised words of a name: neither titles nor words that introduce one.
_NAME = r"(?!(?:" + "|".join([*TITLES, *(w.title() for w in NEAR["person"])]) + r")\b)" + CAPITAL
PERSON = re.compile(r"(?<!\w)(?:(?:" + "|".join(TITLES) + r")\.? )?" + _NAME + r"(?: [A-Z]\.)?(?: " + _NAME + r"){1,2}(?!\w)")
AGAINST = ("sha", "sha1", "sha256", "md5", "commit", "checksum", "hash", "isbn", "version", "order", "invoice", "page")
# A run of any length and any signs after such a word and a sign; `secret_run` says where it ends.
TOLD = re.compile(r"(?i)(?<![a-z0-9])(?P<word>" + "|".join(NEAR["secret"]) + r")[\"']?[ \t]{0,8}[=:][ \t]{0,8}[\"']?(?P<run>[^\s\"'<>`]++)")
#: Words after which even a run of plain letters is meant as a secret, from this many characters on.
PLAIN_AFTER, PLAIN_LENGTH = ("password", "passwd", "passphrase", "pwd", "secret", "token"), 6
CONTEXT = 40
WORD = re.compile(r"\w+")
HIT, MISS, ABSTAIN = "1", "0", "-"
N_LABELERS = 5


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, one trial per `@`: the local part is the whole run before it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    found = []
    for run in DOTTED.finditer(text):
        if text.count(".", *run.span()) >= 3:
            for m in IP.finditer(text, *run.span()):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    found.append(m.span())
    return found


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds, by start and kind."""
    spans = [(a, k, b) for k, f in zip(BASE_KINDS, (emails, ips, cards, phones)) for a, b in f(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def secret_run(text: str, m: re.Match) -> tuple[int, int] | None:
    """The span a told secret has: no closing signs, and in a query string no further parameter."""
    start, end = m.span("run")
    if m.start() and text[m.start() - 1] in "?&":
        end = min([end, *[at for at in (text.find("&", start, end), text.find("#", start, end)) if at >= 0]])
    while end > start and text[end - 1] in ".,;:!?)]}":
        end -= 1
    value = text[start:end]
    plain = m["word"].lower() in PLAIN_AFTER and end - start >= PLAIN_LENGTH and text[end : end + 1] != " "
    return (start, end) if plain or (re.search("[0-9]", value) and re.search("[A-Za-z]", value)) else None


def strict_shape(kind: str, value: str) -> bool:
    if kind == "secret":
        return bool(re.fullmatch(r"[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_\w{36,}|sk-\w{20,}", value))
    if kind == "account":
        bare = value.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    if kind == "contact":
        return value.startswith("(") == (")" in value)
    if kind == "national":
        area = re.fullmatch(r"([0-9]{3})-([0-9]{2})-([0-9]{4})", value)
        return not area or not (area[1] in ("000", "666") or area[1] >= "900" or area[2] == "00" or area[3] == "0000")
    if kind == "address":
        return True  # the pattern names the street's kind
    if kind == "person":
        return value.split()[0].rstrip(".") in TITLES
    return value.islower() or "_" in value


def labels_of(kind: str, text: str, start: int, end: int) -> str:
    """One vote per labeler: strict shape, variety of characters, gazetteer before, gazetteer after, context sign."""
    value = text[start:end]
    before = [w.lower() for w in WORD.findall(text[max(0, start - CONTEXT) : start])][-3:]
    after = [w.lower() for w in WORD.findall(text[end : end + CONTEXT])][:2]
    digits, letters = sum(c.isdigit() for c in value), sum(c.isalpha() for c in value)
    varied = {
        "secret": digits >= 4 and letters >= 4, "account": digits >= 8, "contact": len(set(value)) >= 5, "handle": letters >= 3,
        "national": len(set(value) - set(" -")) >= 4, "address": digits >= 1 and letters >= 6, "person": letters >= 6,
    }[kind]
    names = {w for b in before for w in (b, *b.split("_"))}
    signed = HIT if before and re.search(r"[=:]\s*[\"']?\Z", text[max(0, start - 4) : start]) else ABSTAIN
    spoken = HIT if names & set(NEAR[kind]) else MISS if names & set(AGAINST) else ABSTAIN
    follows = HIT if set(after) & set(NEAR[kind]) else ABSTAIN
    return "".join((HIT if strict_shape(kind, value) else MISS, HIT if varied else MISS, spoken, follows, signed))


def features_of(text: str, start: int, end: int) -> str:
    """What the classifier sees besides the votes, a letter each: length, share of digits, case, sign before, sign after."""
    value = text[start:end]
    length = "abcd"[sum(len(value) >= n for n in (12, 24, 48))]
    digits = "abcd"[sum(sum(c.isdigit() for c in value) >= share * len(value) for share in (0.01, 0.3, 0.7))]
    case = "l" if value.islower() else "u" if value.isupper() else "m"
    around = ["e" if not c else "s" if c.isspace() else "q" if c in "\"'`" else "g" if c in "=:" else "w" if c.isalnum() else "p" for c in (text[start - 1 : start] if start else "", text[end : end + 1])]
    return "".join((length, digits, case, *around))


CANDIDATES = (
    ("account", ACCOUNT), ("secret", SECRET), ("contact", CONTACT), ("handle", HANDLE),
    ("national", NATIONAL), ("address", ADDRESS), ("person", PERSON),
)


def named(text: str, start: int, end: int) -> bool:
    """Whether anything but capitals speaks for a person: a title, or a word of the gazetteer close by."""
    near = WORD.findall(text[max(0, start - CONTEXT) : start])[-3:]
    return strict_shape("person", text[start:end]) or bool({w.lower() for w in near} & set(NEAR["person"]))


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, pattern) of all wide candidates that lie in no base span; they may overlap.

    A candidate may hold a base span, as a secret may hold digits that pass for a card.

    The pattern is the kind, the labelers' votes and a few features of the span and its surroundings.
    """
    starts = np.array([a for a, _, _ in base], int)  # base spans come by start
    furthest = np.maximum.accumulate(np.array([b for _, _, b in base], int)) if base else starts
    found: list[tuple[int, str, int]] = []
    told = {span for m in TOLD.finditer(text) if (span := secret_run(text, m))}
    for kind, pattern in CANDIDATES:
        spans = {m.span() for m in pattern.finditer(text)} if kind != "handle" or "@" in text else set()
        if kind == "secret":
            spans = told | {(a, b) for a, b in spans if re.search("[0-9]", text[a:b]) and re.search("[A-Za-z]", text[a:b])}
        elif kind == "person":
            spans = {(a, b) for a, b in spans if named(text, a, b)}
        for a, b in sorted(spans):
            before = int(np.searchsorted(starts, a, "right"))  # base spans that start no later
            if not before or furthest[before - 1] < b:
                found.append((a, kind, b))
    found.sort(key=lambda s: (s[0], -s[2]))
    return [(a, kind, b, f"{kind}:{labels_of(kind, text, a, b)}:{features_of(text, a, b)}") for a, kind, b in found]


def resolve(found: Iterable[tuple[int, str, int, str]], chances: Mapping[str, float]) -> list[tuple[int, str, int]]:
    """(start, kind, end) of candidates with a pattern in `chances`, the likelier first where they overlap.

    Equally likely ones: the earlier, the longer, the kind listed first. The result is in order.
    """
    starts: list[int] = []
    kept: list[tuple[int, str, int]] = []
    good = [s for s in found if s[3] in chances]
    for a, kind, b, _ in sorted(good, key=lambda s: (-chances[s[3]], s[0], -s[2], KINDS.index(s[1]))):
        at = bisect_left(starts, a)
        if (at and kept[at - 1][2] > a) or (at < len(starts) and starts[at] < b):
            continue
        starts.insert(at, a)
        kept.insert(at, (a, kind, b))
    return kept


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and extra (candidates with patterns) per document, found in the whole text."""
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
    extra_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("pattern", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, extra = [], []
            for text in texts(batch):
                own = base_spans(text or "")
                base.append([dict(zip(("start", "kind", "end"), s)) for s in own])
                extra.append([dict(zip(("start", "kind", "end", "pattern"), s)) for s in candidates(text or "", own)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, base_type), pa.array(extra, extra_type)], ["doc_id", "base", "extra"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start:long,kind:string,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, base {spans}, extra array<struct<start:long,kind:string,end:long,pattern:string>>")


def pattern_counts(docs: DataFrame) -> dict[str, int]:
    """Occurrences of each pattern; at most kinds * 3 ** labelers * values of the features of them, far fewer in fact."""
    return counts_of(scan(docs).select("extra"))


def counts_of(scanned: DataFrame) -> dict[str, int]:
    each = scanned.select(F.explode("extra.pattern").alias("pattern"))
    return {r["pattern"]: r["n"] for r in each.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()}


def voted(pattern: str) -> str:
    """Kind and votes of a pattern, without the features."""
    return ":".join(pattern.split(":")[:2])


def reliabilities(patterns: Mapping[str, int], rounds: int = 60) -> dict[str, float]:
    """Probability that spans of a kind and votes are personal data, by EM over the labelers' votes.

    A labeler's hit rate and false-hit rate are shared by all kinds and kept on the side of
    better than chance; each kind has its own prior.
    """
    whole: dict[str, int] = {}
    for k, n_of in patterns.items():
        whole[voted(k)] = whole.get(voted(k), 0) + n_of
    patterns, keys = whole, list(whole)
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([[(c == HIT) - (c == MISS) for c in k.split(":")[1]] for k in keys], float).reshape(len(keys), N_LABELERS)
    kinds = np.array([KINDS.index(k.split(":")[0]) for k in keys], int)
    prior = np.full(len(KINDS), 0.3)
    right = np.tile(np.array([0.8, 0.8]), (N_LABELERS, 1))
    p = np.zeros(len(keys))
    for _ in range(rounds if keys else 0):
        on_no, on_yes = right[:, 0], right[:, 1]
        odds = np.log(prior / (1 - prior))[kinds] + (votes == 1) @ np.log(on_yes / (1 - on_no)) + (votes == -1) @ np.log((1 - on_yes) / on_no)
        p = 1 / (1 + np.exp(-odds))
        for side, (mass, vote) in enumerate((((1 - p) * n, -1), (p * n, 1))):
            right[:, side] = np.clip((mass @ (votes == vote) + 4) / (mass @ (votes != 0) + 5), 0.55, 0.99)
        prior = np.clip((np.bincount(kinds, p * n, len(KINDS)) + 0.3) / (np.bincount(kinds, n, len(KINDS)) + 1), 0.02, 0.9)
    return dict(zip(keys, p.tolist()))


def train(patterns: Mapping[str, int], rounds: int = 30, penalty: float = 1.0) -> dict[str, float]:
    """The span classifier: logistic regression on kind, votes and features, with the EM posteriors as labels.

    Labelers vote; the classifier also sees what none of them does: length, digits, case and the signs around a span.
    Fitted by Newton steps on pattern counts, so its cost does not depend on the corpus.
    Returns the classifier's probability of each pattern.
    """
    keys = list(patterns)
    if not keys:
        return {}
    soft = reliabilities(patterns)
    n = np.array([patterns[k] for k in keys], float)
    y = np.array([soft[voted(k)] for k in keys])
    seen = sorted({(i, c) for k in keys for i, c in enumerate(k.split(":")[2] if k.count(":") == 2 else "")})
    rows = []
    for k in keys:
        kind, votes, *more = k.split(":")
        own = set(enumerate(more[0])) if more else set()
        rows.append([1.0] + [float(c == HIT) for c in votes] + [float(c == MISS) for c in votes] + [float(kind == x) for x in KINDS[4:]] + [float(f in own) for f in seen])
    x = np.array(rows)
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + ridge, x.T @ (n * (y - p)) - ridge @ w)
    return dict(zip(keys, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))


def accepted(patterns: Mapping[str, int], threshold: float = 0.5) -> list[str]:
    return sorted(chances(patterns, threshold))


def chances(patterns: Mapping[str, int], threshold: float = 0.5) -> dict[str, float]:
    """The classifier's probabilities of the accepted patterns, at nine decimals."""
    return {k: round(p, 9) for k, p in train(patterns).items() if p >= threshold}


def resolved(scanned: DataFrame, good: Mapping[str, float]) -> DataFrame:
    """`scanned` with the accepted candidates that remain in place of `extra`."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
    at = scanned.columns.index("extra")
    schema = scanned.drop("extra").withColumn("added", F.array().cast("array<struct<start:long,kind:string,end:long>>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = []
            for found in batch.column(at):
                own = [(s["start"], s["kind"], s["end"], s["pattern"]) for s in found.as_py()]
                added.append([dict(zip(("start", "kind", "end"), s)) for s in resolve(own, good)])
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(added, span_type)], schema.names)

    return scanned.mapInArrow(run, schema)


def ordered(spans: Column) -> Column:
    """Spans by start, kind as listed, end."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("at"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, base and all spans (start, kind, end; code points, end exclusive) per document.

    Base spans always stay. Candidates are added if the span classifier, trained on the
    votes of all candidates of `docs`, gives them `threshold` or more; of those that overlap, the
    likeliest, then the earlier, the longer, the kind listed first. Null text is empty; texts of any length are
    searched whole; repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    scanned = scratch(scan(docs), "pii-spans")
    chosen = resolved(scanned, chances(counts_of(scanned), threshold))
    return chosen.select("doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", "added")).alias("spans"))


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps join under the first kind."""
    out, end = [], 0
    for a, kind, b in spans:
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`docs` with personal data masked in `text`, and `n_chars` (if there) set to the new length.

    Null and empty texts stay as they are, as do repeated rows and all other columns; an empty table gives no rows.
    Two passes over the text: one counts vote patterns, one finds spans again and masks
    them where the text is, so that no text is shuffled.
    """
    good = chances(pattern_counts(docs), threshold)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = []
            for text in texts(batch):
                if text:
                    base = base_spans(text)
                    more = resolve(candidates(text, base), good)
                    text = mask(text, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))
                masked.append(text)
            columns = [pa.array(masked, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
