"""Personal data in texts: patterns, and a semi-Markov conditional random field.

1. *Patterns* find emails, IPv4 addresses, payment cards and phone numbers; what
   they find always stays.
2. *Islands.*  A segment that can be personal data holds a digit or an at sign.
   The words that do, with what stands between neighbours one blank apart, are
   islands; all other text is outside for certain, so each island is decoded by
   itself with the same result as the whole text.
3. *Segments.*  Within an island every stretch of at most ``LONGEST`` tokens that
   has the outline of a kind is a candidate (a phone number without a plus, an
   at sign in words, a defanged address, other separators).  Features look at
   the whole segment: its digits, groups, separators, edges, the words before.
4. *Decoding.*  A segment scores the sum of its features' weights, a token outside
   nothing, and each change of label has a weight, too.  The best segmentation, all boundaries and
   kinds at once, comes from a dynamic program over (token, last label), which
   looks back over candidates of bounded length only.
5. *Training.*  The pattern's own spans are the labels of a bounded sample: at most ``SAMPLE``
   different islands per kind found in them, in hash order, and as many without
   any.  The conditional likelihood's gradient comes from the
   forward-backward recursion over segments.  Surface features (the plus, the
   literal at sign) are left out in a share of the steps, so that weight goes to
   what else tells the kind.  ``PRIOR`` is the mean that weights are drawn to.

Spans are in code points, end exclusive.  A span of the model that overlaps one
of the patterns is not added.

Defined results: a null text is empty and has no spans; rows are judged one by
one, so null and repeated ids, ties and repeated rows each keep their row; long texts are
scanned in time linear in their length; an empty table gives an empty result
and leaves the weights at their prior.  Only ``doc_id`` and ``text`` are read,
clashing column names do no harm.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.scratch import pick

KINDS = ("email", "ip", "card", "phone")
LONGEST = 40          # tokens of a segment
SAMPLE = 150          # training islands per kind
TRAIN_CHARS = 300     # longer islands train nothing
EPOCHS, RATE, PULL, LEAVE_OUT = 12, 0.4, 0.002, 0.3
#: Means of the weights' prior: outlines that the patterns refuse count against a segment until data say otherwise.
PRIOR = {"phone": -2.0, "phone:bare": -6.0, "phone:cue": 6.0, "phone:date": -6.0, "phone:cut": -6.0, "card": -1.0, "card:cut": -6.0,
         "card:digits0": -2.0, "card:digits1": -2.0, "email": -0.5, "email:nodot": -4.0, "ip": -0.5, "ip:cut": -6.0}

# ---- patterns -----------------------------------------------------------------
_AT = re.compile(r"@([A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CORE = re.compile(r"[0-9]++|@|[(\[] ?[Aa][Tt] ?[)\]]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """What the patterns find, by kind, then start."""
    out, behind = [], 0
    if "@" in text:
        for m in _AT.finditer(text):
            start = m.start()
            while start > behind and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(Span("email", start, m.end()))
                behind = m.end()
    out += [Span("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(n := p.lstrip("0")) < 4 and int(n or 0) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append(Span("card", *m.span()))
    if "+" in text:
        out += [Span("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# ---- islands and candidate segments ---------------------------------------------
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\W\d_]+|[(\[] ?[Aa][Tt] ?[)\]]|\[\.\]|.", re.S)
_WORDS = {"d", "a", "u"}
_CUES = {"phone": re.compile(r"(?i)\b(?:tel|phone|telephone|call|fax|mobile|mobil|cell|whatsapp|ring)\b[^A-Za-z0-9]*$"),
         "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta)\b[^A-Za-z0-9]*$"),
         "ip": re.compile(r"(?i)\b(?:ip|address|host|server|ping)\b[^A-Za-z0-9]*$"),
         "email": re.compile(r"(?i)\b(?:mail|email|e-mail|mailto|contact|write)\b[^A-Za-z0-9]*$")}


class Token(NamedTuple):
    kind: str     # d digits, a ASCII letters, u other letters, @, ., else the character
    start: int
    end: int


class Segment(NamedTuple):
    first: int    # token
    behind: int
    kind: str
    features: list[str]


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text that may hold personal data."""
    start = end = -1
    for m in _CORE.finditer(text):
        if m.start() >= end:
            first = m.start()
            while first > max(end, 0) and m.start() - first < 64 and not text[first - 1].isspace():
                first -= 1
            if start < 0:
                start = first
            elif first > end + 1:      # more than one blank between
                yield start, end
                start = first
        end = max(end, m.end())
        while end < len(text) and end - m.end() < 64 and not text[end].isspace():
            end += 1
    if start >= 0:
        yield start, end


def tokens_of(text: str, start: int, end: int) -> list[Token]:
    out = []
    for m in _TOKEN.finditer(text, start, end):
        c = text[m.start()]
        kind = ("d" if "0" <= c <= "9" else "a" if c.isascii() and c.isalpha() else "u" if c.isalpha()
                else "@" if m.end() - m.start() > 3 or c == "@" else "." if m[0] == "[.]" else c)
        out.append(Token(kind, *m.span()))
    return out


def _size(n: int, *edges: int) -> str:
    return str(sum(n >= e for e in edges))


def _emails(text: str, t: list[Token], kinds: list[str]) -> Iterator[Segment]:
    local, domain = {"a", "d", ".", "_", "%", "+", "-"}, {"a", "d", ".", "-"}
    for k in [i for i, x in enumerate(kinds) if x == "@"]:
        least = k
        while least > max(0, k - LONGEST // 2) and kinds[least - 1] in local:
            least -= 1
        most = k + 1
        while most < min(len(t), k + LONGEST // 2) and kinds[most] in domain and not (kinds[most] == "." == kinds[most - 1]):
            most += 1
        for s in range(least, k):
            if s != least and (kinds[s] not in _WORDS or kinds[s - 1] in _WORDS) or s and kinds[s - 1] == "u":
                continue
            for e in range(k + 2, most + 1):
                if kinds[e - 1] not in ("a", "d") or kinds[k + 1] == "." or e < len(t) and kinds[e] in _WORDS:
                    continue
                dots = sum(x == "." for x in kinds[k + 1:e])
                last = t[e - 1]
                f = ["email", "email:nodot" if not dots else f"email:dots{min(dots, 3)}",
                     "s:email:at" if text[t[k].start] == "@" else "email:spelled",
                     "email:ending" if last.kind == "a" and kinds[e - 2] == "." and 2 <= last.end - last.start <= 6 else "email:odd",
                     "email:wide" if s == least else "email:cut", "email:full" if e == most or kinds[e] != "." else "email:part",
                     "email:local" + _size(t[k].start - t[s].start, 2, 5, 10, 30)]
                yield Segment(s, e, "email", f)


def _addresses(text: str, t: list[Token], kinds: list[str]) -> Iterator[Segment]:
    for s in range(len(t) - 6):
        if kinds[s:s + 7] != ["d", ".", "d", ".", "d", ".", "d"] or s and kinds[s - 1] in _WORDS or s + 7 < len(t) and kinds[s + 7] in _WORDS:
            continue
        parts = [text[t[i].start:t[i].end] for i in range(s, s + 7, 2)]
        if all(len(p) <= 3 and int(p) < 256 for p in parts):
            cut = s > 1 and kinds[s - 2:s] == ["d", "."] or kinds[s + 7:s + 9] == [".", "d"]
            plain = all(t[i].end - t[i].start == 1 for i in range(s + 1, s + 7, 2))
            yield Segment(s, s + 7, "ip", ["ip", "ip:cut" if cut else "ip:whole", "s:ip:dots" if plain else "ip:defanged",
                                           "ip:zero" if any(p[0] == "0" != p for p in parts) else "ip:plain"])


def _numbers(text: str, t: list[Token], kinds: list[str]) -> Iterator[Segment]:
    """Cards and phone numbers: groups of digits with separators."""
    for s in range(len(t)):
        if kinds[s] not in ("d", "+", "(") or s and (kinds[s - 1] in _WORDS or kinds[s - 1] == "@"):
            continue
        groups: list[str] = []
        seps: list[str] = []
        for e in range(s, min(len(t), s + LONGEST)):
            x = kinds[e]
            if x != "d":
                if e > s and (x not in " ().-/" or len(seps) > 1 and kinds[e - 1] != "d" != kinds[e - 2]):
                    break
                seps.append(x)
                continue
            groups.append(text[t[e].start:t[e].end])
            digits = "".join(groups)
            if len(digits) > 19:
                break
            if e + 1 < len(t) and (kinds[e + 1] in _WORDS or kinds[e + 1] == "@"):
                continue
            more = e + 2 < len(t) and kinds[e + 2] == "d" and kinds[e + 1] in " -./"
            fewer = s > 1 and kinds[s - 2] == "d" and kinds[s - 1] in " -./" or s and kinds[s - 1] in "+("
            sizes = [len(g) for g in groups]
            inner = seps[1:] if kinds[s] != "d" else seps
            if kinds[s] == "d" and len(digits) >= 12 and len(inner) == len(groups) - 1 and luhn(digits):
                shape = "one" if len(groups) == 1 else "fours" if set(sizes[:-1]) == {4} else "groups"
                yield Segment(s, e + 1, "card", [
                    "card", "card:cut" if more or fewer else "card:whole", f"card:{shape}", f"card:seps{min(2, len(set(inner)))}",
                    "card:digits" + _size(len(digits), 13, 16), "card:issuer" if digits[0] in "3456" else "card:other"])
            if 7 <= len(digits) <= 15:
                date = len(groups) == 3 and sorted(sizes) in ([2, 2, 4], [1, 2, 4], [1, 1, 4])
                years = len(groups) == 2 and sizes == [4, 4] and kinds[s] == "d"
                dotted = len(groups) == 4 and set(inner) == {"."}
                f = ["phone", "s:phone:plus" if kinds[s] == "+" else "phone:bracket" if kinds[s] == "(" else
                     "phone:00" if digits.startswith("00") else "phone:bare",
                     "phone:date" if date or years or dotted else "phone:nodate",
                     "phone:cut" if more or fewer else "phone:whole",
                     "phone:groups" + _size(len(groups), 2, 3, 4, 6), "phone:digits" + _size(len(digits), 8, 10, 13),
                     f"phone:seps{min(3, len(set(inner)))}"]
                if "(" in seps and ")" in seps:
                    f.append("phone:area")
                yield Segment(s, e + 1, "phone", f)


def candidates(text: str, tokens: list[Token]) -> list[Segment]:
    """All segments of an island that may be personal data, by end."""
    kinds = [x.kind for x in tokens]
    found: list[Segment] = []
    if "@" in kinds:
        found += _emails(text, tokens, kinds)
    if "d" in kinds:
        found += _addresses(text, tokens, kinds)
        found += _numbers(text, tokens, kinds)
    out = []
    for g in found:
        at = tokens[g.first].start
        before = text[max(0, at - 24):at]
        cues = [f"{g.kind}:cue" if k == g.kind else f"{g.kind}:othercue" for k, cue in _CUES.items() if cue.search(before)]
        out.append(g._replace(features=[*g.features, *cues]))
    return sorted(out, key=lambda g: g.behind)


# ---- the model -------------------------------------------------------------------
LABELS = ("O", *KINDS)


class Model:
    """Weights by feature; ``a>b`` for a change from label a to label b.  A token
    outside has no feature: what is outside scores 0, however long it is."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights

    def _arcs(self, tokens: list[Token], segments: list[Segment], left_out: frozenset[str] = frozenset()):
        """Arcs (first token, label, score, features) by the token behind them."""
        w = self.weights
        arcs: list[list] = [[] for _ in range(len(tokens) + 1)]
        for n in range(len(tokens)):
            arcs[n + 1].append((n, "O", 0.0, ()))
        for g in segments:
            f = [x for x in g.features if x not in left_out]
            arcs[g.behind].append((g.first, g.kind, sum(w.get(x, 0.0) for x in f), f))
        return arcs

    def _change(self, a: str, b: str) -> float:
        return self.weights.get(f"{a}>{b}", 0.0)

    def best(self, tokens: list[Token], segments: list[Segment]) -> list[Segment]:
        """The segments of the best segmentation."""
        if not segments:
            return []
        arcs = self._arcs(tokens, segments)
        at: list[dict[str, tuple]] = [{"O": (0.0, None)}]
        for behind in range(1, len(tokens) + 1):
            here: dict[str, tuple] = {}
            for first, label, score, _ in arcs[behind]:
                for before, (so_far, _) in at[first].items():
                    value = so_far + score + self._change(before, label)
                    if label not in here or value > here[label][0]:
                        here[label] = (value, (first, before))
            at.append(here)
        # the text goes on outside
        label = max(at[-1], key=lambda x: (at[-1][x][0] + self._change(x, "O"), x))
        behind, out = len(tokens), []
        while behind:
            first, before = at[behind][label][1]
            if label != "O":
                out.append(Segment(first, behind, label, []))
            behind, label = first, before
        return out[::-1]

    def expected(self, tokens: list[Token], segments: list[Segment], left_out: frozenset[str] = frozenset()) -> tuple[float, dict[str, float]]:
        """(log of the sum over all segmentations, expected count of each feature)."""
        arcs = self._arcs(tokens, segments, left_out)
        n = len(tokens)
        fore: list[dict[str, float]] = [{"O": 0.0}] + [{} for _ in range(n)]
        for behind in range(1, n + 1):
            terms: dict[str, list[float]] = {}
            for first, label, score, _ in arcs[behind]:
                terms.setdefault(label, []).extend(v + score + self._change(b, label) for b, v in fore[first].items())
            fore[behind] = {k: _log_sum(v) for k, v in terms.items() if v}
        total = _log_sum([v + self._change(b, "O") for b, v in fore[n].items()])
        back: list[dict[str, list[float]]] = [{} for _ in range(n + 1)]
        back[n] = {b: [self._change(b, "O")] for b in fore[n]}
        count: dict[str, float] = {}
        for b, v in fore[n].items():
            count[f"{b}>O"] = count.get(f"{b}>O", 0.0) + math.exp(v + self._change(b, "O") - total)
        for behind in range(n, 0, -1):
            ends = {k: _log_sum(v) for k, v in back[behind].items()}
            for first, label, score, f in arcs[behind]:
                if label not in ends:
                    continue
                whole = 0.0
                for b, v in fore[first].items():
                    step = score + self._change(b, label) + ends[label]
                    back[first].setdefault(b, []).append(step)
                    p = math.exp(v + step - total)
                    whole += p
                    count[f"{b}>{label}"] = count.get(f"{b}>{label}", 0.0) + p
                for x in f:
                    count[x] = count.get(x, 0.0) + whole
        return total, count


def _log_sum(v: list[float]) -> float:
    top = max(v)
    return top + math.log(sum(math.exp(x - top) for x in v))


def _counts(tokens: list[Token], chosen: list[Segment], left_out: frozenset[str] = frozenset()) -> dict[str, float]:
    """Features of one segmentation."""
    count: dict[str, float] = {}

    def add(x: str) -> None:
        count[x] = count.get(x, 0.0) + 1.0
    at, label = 0, "O"
    for g in [*chosen, None]:
        for _ in range(at, g.first if g else len(tokens)):
            add(f"{label}>O")
            label = "O"
        if g:
            for x in g.features:
                if x not in left_out:
                    add(x)
            add(f"{label}>{g.kind}")
            at, label = g.behind, g.kind
    add(f"{label}>O")
    return count


def _labelled(text: str, start: int, end: int, spans: list[Span]) -> tuple[list[Token], list[Segment], list[Segment] | None]:
    """(tokens, candidates, the candidates that the patterns found; None if
    one of them is no candidate)."""
    tokens = tokens_of(text, start, end)
    segments = candidates(text, tokens)
    by = {(tokens[g.first].start, tokens[g.behind - 1].end, g.kind): g for g in segments}
    chosen: list[Segment] = []
    for span in sorted((x for x in spans if x.start < end and x.end > start), key=lambda x: x.start - x.end):
        g = by.get((span.start, span.end, span.kind))
        if g is None:
            return tokens, segments, None
        if all(g.behind <= c.first or g.first >= c.behind for c in chosen):   # of overlapping ones the longest
            chosen.append(g)
    return tokens, segments, sorted(chosen)


def fit(sample: list[str]) -> Model:
    """Weights from islands with some text before them, by the likelihood of
    what the patterns find in them."""
    examples = []
    for text in sample:
        spans = pattern_spans(text)
        for start, end in islands(text):
            tokens, segments, chosen = _labelled(text, start, end, spans)
            if segments and chosen is not None:
                examples.append((tokens, segments, chosen))
    model, seen = Model(dict(PRIOR)), {}
    rng = random.Random(0)
    surface = sorted({f for _, segments, _ in examples for g in segments for f in g.features if f.startswith("s:")})
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for tokens, segments, chosen in examples:
            out = frozenset(f for f in surface if rng.random() < LEAVE_OUT)
            step = _counts(tokens, chosen, out)
            for f, n in model.expected(tokens, segments, out)[1].items():
                step[f] = step.get(f, 0.0) - n
            step.pop("O>O", None)
            for f, g in step.items():
                w = model.weights.get(f, 0.0)
                g -= PULL * (w - PRIOR.get(f, 0.0))
                seen[f] = seen.get(f, 1e-3) + g * g
                model.weights[f] = w + RATE * g / math.sqrt(seen[f])
    return model


def training_sample(texts: DataFrame) -> list[str]:
    """Islands (with the text just before them) of a column ``text``: at most
    ``SAMPLE`` different ones for each kind, and for none, in hash order."""
    most = TRAIN_CHARS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for text in batch.column(0):
                text = text.as_py()
                if text and _CORE.search(text):
                    spans = iter(sorted(pattern_spans(text), key=lambda x: x.start))
                    span = next(spans, None)
                    behind = 0
                    for start, end in islands(text):
                        kind = "none"
                        while span and span.start < end:
                            kind = span.kind if span.end > start else kind
                            span = next(spans, None)
                        if end - start <= most:
                            rows.add((kind, text[max(behind, start - 24):end]))
                        behind = end
            kinds, found = zip(*sorted(rows)) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(found, pa.string())], names=["kind", "island"])

    rows = texts.select("text").mapInArrow(cut, "kind string, island string").distinct()
    first = W.partitionBy("kind").orderBy(F.xxhash64("island"), "island")
    taken = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE)
    return sorted(r["island"] for r in taken.select("island").collect())


def all_spans(text: str, model: Model) -> list[tuple[Span, bool]]:
    """(span, whether a pattern found it), by kind, then start."""
    if not _CORE.search(text):
        return []
    base = pattern_spans(text)
    more, held = [], iter(sorted(base, key=lambda x: x.start))
    near: list[Span] = []
    span = next(held, None)
    for start, end in islands(text):
        tokens = tokens_of(text, start, end)
        segments = candidates(text, tokens)
        near = [x for x in near if x.end > start]
        while span and span.start < end:
            near.append(span)
            span = next(held, None)
        for g in model.best(tokens, segments):
            found = Span(g.kind, tokens[g.first].start, tokens[g.behind - 1].end)
            if all(found.end <= x.start or found.start >= x.end for x in near):
                more.append(found)
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted([(x, True) for x in base] + [(x, False) for x in more], key=lambda x: (order[x[0].kind], x[0].start, x[0].end))


def _said(spans: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in spans)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, spans (kind, start, end, by_pattern: by kind, then start) and the
    texts of base_spans and all_spans, a row for each row of ``docs``; without
    a model, one is trained on a sample of them."""
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("string"))
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast((model or fit(training_sample(rows))).weights)
    span = "struct<kind:string,start:int,end:int,by_pattern:boolean>"
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_pattern", pa.bool_())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Model(weights.value)
        for batch in batches:
            found = [all_spans(t.as_py() or "", judge) for t in batch.column(1)]
            base = [_said([s for s, by in f if by]) for f in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([[{"kind": s.kind, "start": s.start, "end": s.end, "by_pattern": by} for s, by in f] for f in found], pa.list_(kind_of)),
                pa.array(base, pa.string()), pa.array([_said([s for s, _ in f]) for f in found], pa.string())],
                names=["doc_id", "spans", "base_spans", "all_spans"])

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {key}, spans array<{span}>, base_spans string, all_spans string")
