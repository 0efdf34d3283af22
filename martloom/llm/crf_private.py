"""Personal data by patterns and a linear-chain conditional random field.

Four kinds are matched by pattern and check: e-mail addresses, IPv4 addresses, payment
card numbers (Luhn) and international phone numbers. A field over word shapes, trained
from a small labelled table, adds spans the patterns miss (numbers written without the
plus sign, in brackets, with a label beside them …). A word without a digit or an at
sign is outside by definition, unless it is a sign written apart between such words, lies
beside a lone at sign, or is part of an address spelt with "at" and "dot"; so the Viterbi
path falls into runs, decoded side by side in numpy batches (long ones in blocks of
themselves); the words around a run are features of it. All scans take time in
proportion to the text, whatever it holds.

Pattern spans stay; a decoded span that overlaps one, or that has not the digits of its
kind (a card must pass Luhn), is dropped. Offsets are code
points, ends exclusive. Null and empty texts have no span. Repeated rows are searched
each time. Input columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row

KINDS = ("email", "ip", "card", "phone")
LONG = 512  # words of a run that is decoded in blocks
# Characters of an e-mail's local part, and its domain. Possessive: a domain never gives back
# characters, as what follows them must not be of their class.
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# An address begins where a run of digits does; from inside the run the same would follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = frozenset(" \t\n\x0b\x0c\r")
_TRIGGER = re.compile(r"[0-9@]")
# Signs written apart between the words of a number, and an address with its signs in words.
_SIGNS = re.compile(r"[ \t]+[-()+./ \t]{1,8}[ \t]+")
_SPELT = re.compile(
    r"(?<!\S)[A-Za-z0-9._%+-]++[ \t]+[(\[]?at[)\]]?[ \t]+[A-Za-z0-9-]++(?:[ \t]+[(\[]?dot[)\]]?[ \t]+[A-Za-z0-9-]++)+", re.IGNORECASE
)
_DOT = re.compile(r"dot", re.IGNORECASE)
_ONE_SIGN = re.compile(r"[^@\s]+(?:[ \t]+@[ \t]+|@)[^@\s]+")

# The labelled table: words, with marked spans as [kind words].
LABELLED = (
    "write to [email anna.b@mail.example.org] today .",
    "mail [email x_9@host-1.example.com] or call",
    "contact: [email first.last+tag@sub.example.net]",
    "address is [email 77@mail4.example.com] and more words",
    "[email me@example.org]",
    "call me at [phone 020 7946 0958] after six",
    "phone: [phone (555) 010-7788] , ask for",
    "tel. [phone 0049 30 901820] or fax",
    "tel [phone 555-010-4477] now",
    "mobile [phone (018) 555-0142] please",
    "phone [phone 00 44 7700 900123] office",
    "fax [phone (0)30 5550 1299] desk",
    "call [phone +44 20 7946 0018] for help",
    "reach [phone +1 (212) 555-0143] at night",
    "server [ip 192.0.2.17] answered",
    "from host [ip 198.51.100.4] port 8080",
    "ip: [ip 203.0.113.250]",
    "paid by card [card 4111 1111 1111 1111] in full",
    "card number [card 5500-0000-0000-0004] expires 12/27",
    "visa [card 4012888888881881] was charged",
    "in 1999 there were 12 of them and 3,400 more",
    "on 2021-05-17 at 10:30 we met",
    "on 17.05.2021 the price was 19.99 EUR",
    "version 2.0 of the license , section 3.1.4",
    "chapter 12 , page 345 of 678",
    'token = "3f9b43e8e70344a3bb0e1920812ffa66f7838d69" here',
    "key a94a8fe5ccb19ba61c4c0873d391e987982fbbd3 end",
    "order 12345678901234567890 shipped",
    "a total of 1 234 567 people in 2 012 towns",
    "rooms 101 102 103 and 104",
    "see @handle and @other for news",
    "the 3rd and 4th of 10 items cost $ 25.00",
    "ratio 16:9 at 1920x1080 pixels , 60 Hz",
    "isbn 978-3-16-148410-0 second edition",
    "numbers 3992412725776993 and 9940550943172992 here",
    "id 4473447056375032 was seen",
    "12 | 34 | 56 | 78",
    "score 3-2 after 90 minutes",
    "1 2 3 4 5 6 7 8 9 10 11 12",
    "7 8 9 10 and 5 6 7 8 9",
    "version 10.0.19045 build 3803",
    "write to [email anna at example dot org] today",
    "mail [email j.smith (at) mail (dot) example (dot) com] or call",
    "ask [email office at sub dot example dot net] first",
    "reach [email info @ example.org] for more",
    "send it to [email me @ mail.example.com] soon",
    "ask [email paul @ place.example] for it",
    "please mail [email x.y @ office-1.example.org] today",
    "ask [email post at place dot com] about it",
    "then mail [email team at place-2 dot net] or wait",
    "call [phone 555 - 010 - 4477] now",
    "phone: [phone ( 555 ) 010 7788] after six",
    "tel [phone 030/901820] office",
    "fax [phone 020 / 7946 - 0018] desk",
    "he stood at point dot of the map",
    "look at line dot seven of it",
    "open from 10 - 12 and 14 - 18 daily",
    "won 3 - 2 after 90 minutes",
    "pages 12 - 34 - 56 of it",
    "in 2019 / 2020 they sold 1200 / 1300 of them",
    "3 + 4 - 5 is 2",
    "@ home and @ work",
)
_LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_CUES = {"phone": 1, "tel": 1, "call": 1, "mobile": 1, "fax": 1, "reach": 1, "card": 2, "visa": 2, "ip": 3, "host": 3, "server": 3, "at": 4, "dot": 5, "@": 6, "mail": 7, "email": 7, "ask": 7, "contact": 7, "to": 7}
FEATURES = 4096


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The pattern spans of a text by kind, then start; failing matches are dropped."""
    out = []
    at, free = text.find("@"), 0  # the leftmost match with this sign begins with the whole run before it
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            out.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", free)
    if _TRIGGER.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def shape(word: str) -> str:
    """Digits as 9, letters as a, runs of over four of a sign as four and a plus."""
    out = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", "a", word))
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1+", out)


def _number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


def _word_features(word: str, before: str, after: str, cache: dict) -> np.ndarray:
    cue = _CUES.get(before.strip(":.,()[]\"'").lower(), 0)
    said = word.strip("()[]").lower()
    said = said if said in ("at", "dot", "@") else ""
    near = "n" if _TRIGGER.search(before) else "w" if before else "-"
    then = "n" if _TRIGGER.search(after) else "w" if after else "-"
    key = (word if "@" in word else shape(word), cue, near, then, said)
    if key not in cache:
        form = shape(word)
        core = form.strip(".,;:!?\"'()*$%&#|")
        digits = sum(c.isdigit() for c in word)
        names = [
            f"shape={form}", f"core={core}", f"digits={min(digits, 20)}", f"dots={min(word.count('.'), 5)}", f"dash={min(word.count('-'), 4)}",
            f"at={'@' in word.strip('@')}", f"letters={any(c.isalpha() for c in word)}", f"open={word[:1] in '([+'}", f"cue={cue}", f"near={near}",
            f"then={then}", f"digits={min(digits, 20)}&cue={cue}", f"core={core}&near={near}&then={then}", f"said={said}",
        ]
        if len(cache) > 100_000:
            cache.clear()
        cache[key] = np.array([_number(n) for n in names])
    return cache[key]


def _beside(text: str, low: int, high: int) -> tuple[int, int, str, str]:
    before, after = _WORD.findall(text[max(0, low - 40) : low]), _WORD.findall(text[high : high + 40])
    return low, high, before[-1] if before else "", after[0] if after else ""


def _runs(text: str) -> list[list[tuple[int, int, str, str]]]:
    """Runs of words the field decodes: start, end and the words beside each.

    Words with a digit or an at sign, also with signs written apart between them; the
    words around a lone at sign; addresses with their signs in words.
    """
    spelt = [m.span() for m in _SPELT.finditer(text)] if _DOT.search(text) else []
    out = [[_beside(text, low + m.start(), low + m.end()) for m in _WORD.finditer(text[low:high])] for low, high in spelt]
    own: list[tuple[int, int, str, str]] = []
    last, high, k = -1, 0, 0
    for m in _TRIGGER.finditer(text):
        if m.start() < high:
            continue
        while k < len(spelt) and spelt[k][1] <= m.start():
            k += 1
        if k < len(spelt) and spelt[k][0] <= m.start():
            high = spelt[k][1]
            continue
        low, high = m.start(), m.start()
        while low and text[low - 1] not in _SPACE:
            low -= 1
        while high < len(text) and text[high] not in _SPACE:
            high += 1
        gap = text[last:low] if last >= 0 else ""
        signs = [] if last < 0 or low - last > 12 or not _SIGNS.fullmatch(gap) else [w.span() for w in _WORD.finditer(gap)]
        if last >= 0 and (signs or not gap.strip(" \t")):
            own += [_beside(text, last + a, last + b) for a, b in signs]
        else:
            own = []
            out.append(own)
            ahead = _WORD.search(text[max(0, low - 3) : low].lstrip()) if low else None
            if ahead and ahead.group() in ("(", "+", "(+") and text[low - 1] in " \t":  # a bracket written apart
                start = text.rindex(ahead.group(), 0, low)
                own.append(_beside(text, start, start + len(ahead.group())))
            if text[low:high] == "@" and low and text[low - 1] in " \t":
                start = len(text[:low].rstrip(" \t")) if low < 64 else low - 64 + len(text[low - 64 : low].rstrip(" \t"))
                begin = start
                while begin and start - begin < 64 and text[begin - 1] not in _SPACE:
                    begin -= 1
                if begin < start and begin >= last:
                    own.append(_beside(text, begin, start))
        own.append(_beside(text, low, high))
        if text[low:high] == "@":
            after = re.compile(r"[ \t]+([^\x20\x09-\x0D]{1,64})(?![^\x20\x09-\x0D])").match(text, high)
            if after and not _TRIGGER.search(after[1]):
                own.append(_beside(text, after.start(1), after.end(1)))
                high = after.end(1)
        last = high
    return out


class Chain:
    """Weights of the field; ``LABELS`` of kind begin and inside, and outside."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    def logits(self, run: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.emit[f].sum(axis=0) for f in run])


def viterbi_long(logits: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best label path of one long run (words x labels), in blocks of about its root.

    All blocks go on side by side, each from every label it may be entered with; then the
    blocks are chained, and their paths are followed back side by side.
    """
    words, k = logits.shape
    wide = int(np.ceil(np.sqrt(words)))
    blocks = -(-words // wide)
    padded = np.zeros((blocks * wide, k))
    padded[:words] = logits
    own = padded.reshape(blocks, wide, k)
    real = np.arange(blocks * wide).reshape(blocks, wide) < words
    best = np.full((blocks, k, k), -np.inf)  # block, label before it, label now
    best[:, np.arange(k), np.arange(k)] = 0
    back = np.zeros((wide, blocks, k, k), np.int16)
    for t in range(wide):
        total = best[:, :, :, None] + step[None, None]
        came = total.argmax(axis=2)
        new = np.take_along_axis(total, came[:, :, None, :], axis=2)[:, :, 0, :] + own[:, t][:, None, :]
        here = real[:, t][:, None, None]
        back[t] = np.where(here, came, np.arange(k)[None, None, :])
        best = np.where(here, new, best)
    enter = np.zeros((blocks, k), np.int64)  # best label before a block for each label at its end
    score = np.full(k, -np.inf)
    score[0] = 0  # the edge label
    for b in range(blocks):
        total = score[:, None] + best[b]
        enter[b] = total.argmax(axis=0)
        score = total.max(axis=0)
    last = np.zeros(blocks, np.int64)
    state = int((score + step[:, 0]).argmax())
    before = np.zeros(blocks, np.int64)
    for b in range(blocks - 1, -1, -1):
        last[b] = state
        state = before[b] = enter[b, state]
    path = np.zeros((blocks, wide), np.int64)
    at, state = np.arange(blocks), last
    for t in range(wide - 1, -1, -1):
        path[:, t] = state
        state = back[t][at, before, state]
    return path.ravel()[:words]


def viterbi(logits: np.ndarray, size: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best label paths of padded runs (runs x words x labels); 0 is the edge label."""
    n, wide, k = logits.shape
    best = logits[:, 0] + step[0]
    back = np.zeros((n, wide, k), np.int64)
    for t in range(1, wide):
        total = best[:, :, None] + step[None]
        back[:, t] = total.argmax(axis=1)
        new = total.max(axis=1) + logits[:, t]
        best = np.where((size > t)[:, None], new, best)
    path = np.zeros((n, wide), np.int64)
    state = (best + step[:, 0]).argmax(axis=1)
    for t in range(wide - 1, -1, -1):
        path[:, t] = np.where(size > t, state, 0)
        state = np.where((size > t) & (t > 0), back[np.arange(n), t, state], state)
    return path


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def trained(rows: tuple[str, ...] = LABELLED, steps: int = 300, rate: float = 0.1, decay: float = 2e-3) -> Chain:
    """The field of greatest likelihood on the labelled table."""
    cache: dict = {}
    runs, golds = [], []
    for row in rows:
        text, spans, kind = "", [], None
        for piece in re.split(r"(\[[a-z]+ |\])", row):
            if m := re.fullmatch(r"\[([a-z]+) ", piece):
                kind = m[1]
            elif piece != "]":
                if kind:
                    spans.append((len(text), len(text) + len(piece), kind))
                    kind = None
                text += piece
        for run in _runs(text):
            gold = []
            for low, high, *_ in run:
                own = next((s for s in spans if s[0] < high and low < s[1]), None)
                gold.append(0 if own is None else _LABELS.index(f"{'B' if low <= own[0] else 'I'}-{own[2]}"))
            runs.append([_word_features(text[a:b], x, y, cache) for a, b, x, y in run])
            golds.append(gold)
    k = len(_LABELS)
    banned = np.zeros((k, k))
    for j in range(2, k, 2):  # inside follows begin or inside of its kind
        banned[[i for i in range(k) if i not in (j - 1, j)], j] = -30.0
    emit, step = np.zeros((FEATURES, k)), np.zeros((k, k))
    moments = [np.zeros_like(x) for x in (emit, emit, step, step)]
    for t in range(1, steps + 1):
        ge, gs = decay * emit, decay * step
        chain = Chain(emit, step + banned)
        for run, gold in zip(runs, golds, strict=True):
            x, s = chain.logits(run), chain.step
            n = len(run)
            alpha, beta = np.zeros((n, k)), np.zeros((n, k))
            alpha[0] = s[0] + x[0]
            for i in range(1, n):
                alpha[i] = _log_sum(alpha[i - 1][:, None] + s, 0) + x[i]
            beta[-1] = s[:, 0]
            for i in range(n - 2, -1, -1):
                beta[i] = _log_sum(s + x[i + 1] + beta[i + 1], 1)
            z = _log_sum(alpha[-1] + s[:, 0], 0)
            post = np.exp(alpha + beta - z)
            for i in range(n):
                post[i, gold[i]] -= 1
                np.add.at(ge, run[i], post[i])
            path = [0, *gold, 0]
            for i in range(n - 1):
                gs += np.exp(alpha[i][:, None] + s + x[i + 1] + beta[i + 1] - z)
            gs[0] += np.exp(s[0] + x[0] + beta[0] - z)
            gs[:, 0] += np.exp(alpha[-1] + s[:, 0] - z)
            for a, b in zip(path, path[1:], strict=False):
                gs[a, b] -= 1
        for w, g, m, v in ((emit, ge, moments[0], moments[1]), (step, gs, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Chain(emit, step + banned)


def _trimmed(text: str, low: int, high: int) -> tuple[int, int]:
    while low < high and not (text[low].isalnum() or text[low] in "+("):
        low += 1
    while high > low and not (text[high - 1].isalnum() or text[high - 1] == ")"):
        high -= 1
    return low, high


def _plausible(kind: str, span: str) -> bool:
    """What a decoded span must have to be of its kind."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        return _ONE_SIGN.fullmatch(span) is not None or _SPELT.fullmatch(span) is not None
    if kind == "ip":
        parts = re.split(r"[^0-9]+", span.strip("()"))
        return len(parts) == 4 and all(p and _small(p) for p in parts)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 7 <= len(digits) <= 15


def field_spans(texts: list[str], chain: Chain, cache: dict) -> list[list[tuple[str, int, int]]]:
    """Decoded spans of each text."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    runs = [(i, run) for i, text in enumerate(texts) for run in _runs(text)]
    runs.sort(key=lambda x: len(x[1]))
    k = 0
    while k < len(runs):
        wide = max(4, len(runs[k][1]) * 2)
        few = max(1, (1 << 16) // wide)
        part = [r for r in runs[k : k + few] if len(r[1]) <= wide]
        k += len(part)
        size = np.array([len(run) for _, run in part])
        logits = np.zeros((len(part), int(size.max()), len(_LABELS)))
        for n, (i, run) in enumerate(part):
            logits[n, : len(run)] = chain.logits([_word_features(texts[i][a:b], x, y, cache) for a, b, x, y in run])
        paths = [viterbi_long(logits[n, :s], chain.step).tolist() for n, s in enumerate(size)] if size[0] >= LONG else viterbi(logits, size, chain.step).tolist()
        for (i, run), path in zip(part, paths, strict=True):
            open_span = None
            for (low, high, *_), label in zip(run, path, strict=False):
                kind = _LABELS[label][2:]
                if label and label % 2 == 0 and open_span and open_span[0] == kind:
                    open_span = (kind, open_span[1], high)
                    continue
                if open_span:
                    out[i].append(open_span)
                open_span = (kind, low, high) if label else None
            if open_span:
                out[i].append(open_span)
    trimmed = [[(k, *_trimmed(t, a, b)) for k, a, b in own] for t, own in zip(texts, out, strict=True)]
    return [[(k, a, b) for k, a, b in own if a < b and _plausible(k, t[a:b])] for t, own in zip(texts, trimmed, strict=True)]


def spans_of(texts: list[str], chain: Chain, cache: dict) -> list[tuple[list, list]]:
    """Pattern spans and all spans of each text, by kind and start."""
    found = []
    for text, more in zip(texts, field_spans(texts, chain, cache), strict=True):
        base = base_spans(text)
        every = base + [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in base)]
        every.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
        found.append((base, every))
    return found


SPAN = "array<struct<kind: string, start: long, end: long>>"
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _search(chain: Chain):
    def search(column: pa.Array) -> pa.Array:
        base, every, cache = [], [], {}
        for at in range(0, len(column), 256):
            texts = [t or "" for t in column.slice(at, 256).to_pylist()]
            for b, e in spans_of(texts, chain, cache):
                base.append([{"kind": k, "start": s, "end": f} for k, s, f in b])
                every.append([{"kind": k, "start": s, "end": f} for k, s, f in e])
        return pa.StructArray.from_arrays([pa.array(base, _SPAN_ARROW), pa.array(every, _SPAN_ARROW)], names=["base", "spans"])

    return search


def searched(df: DataFrame, text: str = "text", chain: Chain | None = None) -> DataFrame:
    """``df`` with ``base_spans`` (patterns) and ``all_spans`` (with those of the field)."""
    found = per_row(_search(chain or trained()), f"base {SPAN}, spans {SPAN}")(arrays.text_column(text))
    rest = clear(df, "base_spans", "all_spans").columns
    df = df.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)), found.alias("found"))
    spans = F.col("found.base").alias("base_spans"), F.col("found.spans").alias("all_spans")
    return df.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(rest)), *spans)


def span_text(column: str):
    """Spans as ``kind:start:end``, comma-joined."""
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(column, part), ",")
