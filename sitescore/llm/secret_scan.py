"""Secret scan: three base patterns, and tokens in the format of learned credentials.

The base patterns label credentials in a bounded sample of the corpus, and
generated credentials of publicly described formats are labels beside them. From
these, probabilistic automata are inferred, one for each kind; every token of the
credential alphabet is scored by its likelihood under the automata
against that of an ordinary token of the sample.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescore.llm.automata import learn, logs

# fixed patterns of the base kinds
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
BASE = ("assign", "access", "hex")
LEARNED = "inferred"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, value) of the base matches, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    found.sort()
    return found


def tokens_of(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str, bool]]:
    """(start, end, token, whether it touches a base match) of the tokens to score, full stops at their ends left off.

    A token that lies within one base match is that match's and is left out. The
    part of a token after its last ``=`` comes before the token.
    """
    out, at = [], 0
    spans = sorted((s, e) for s, _, e, _ in taken)
    longest = max((e - s for s, e in spans), default=0)
    for m in CANDIDATE.finditer(text):
        word = m[0].rstrip(".")
        inner = word.rstrip("=").rfind("=") + 1
        for cut in (inner, 0) if inner else (0,):
            s, e = m.start() + cut, m.start() + len(word)
            if e - s < 12:
                continue
            while at < len(spans) and spans[at][0] + longest <= m.start():
                at += 1
            touching, k = [], at
            while k < len(spans) and spans[k][0] < e:
                if spans[k][1] > s:
                    touching.append(spans[k])
                k += 1
            if not any(x <= s and e <= y for x, y in touching):
                out.append((s, e, word[cut:], bool(touching)))
    return out


def _likelihood(table, word: str, least: float = -math.inf) -> float | None:
    """log2 of the likelihood; letters never seen in a state cost a floor and leave it. None once it is under ``least``."""
    state, total = 0, 0.0
    for c in word:
        _, floor, steps = table[state]
        step = steps.get(c)
        if step is None:
            total += floor
        else:
            state = step[0]
            total += step[1]
        if total < least:
            return None
    return total + table[state][0]


LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALNUM = LETTERS + LETTERS.upper() + DIGITS
#: Publicly described credential formats: fixed beginning, letters of the rest, lengths of the rest.
KNOWN_FORMATS = {
    "access_temporary": ("ASIA", LETTERS.upper() + "234567", (16,)),
    "access_secret": ("", ALNUM + "+/", (40,)),
    "code_host": ("ghp_", ALNUM, (36,)),
    "code_host_app": ("ghs_", ALNUM, (36,)),
    "code_lab": ("glpat-", ALNUM + "_-", (20,)),
    "payment": ("sk_live_", ALNUM, (24, 32)),
    "payment_hex": ("sk_live_", DIGITS + "abcdef", (32,)),
    "chat_bot": ("xoxb-", DIGITS + "-" + ALNUM, (45, 50)),
    "maps": ("AIza", ALNUM + "_-", (35,)),
    "package_index": ("npm_", ALNUM, (36,)),
    "hex_upper": ("", DIGITS + "ABCDEF", (32, 40)),
    "plain_32": ("", ALNUM, (32,)),
}


def labelled_formats(number: int = 200, seed: int = 17) -> dict[str, list[str]]:
    """``number`` labelled credentials of each known format, drawn from a seed: labels that a corpus may lack."""
    out = {}
    for name, (start, letters, lengths) in KNOWN_FORMATS.items():
        rng = random.Random(f"{seed}:{name}")
        out[name] = [start + "".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(number)]
    return out


class Formats:
    """Automata of the credential kinds, pairs of letters of ordinary tokens, and a threshold for each kind."""

    def __init__(self, positive: dict[str, list[str]], negative: list[str], alpha: float = 0.05, keep: float = 0.02, most: float = 0.05, slack: float = 0.6):
        pairs, ones = Counter(), Counter()
        for word in negative:
            for a, b in zip("^" + word, word + "$"):
                pairs[a, b] += 1
                ones[a] += 1
        self.pairs = {p: math.log2((n + 0.1) / (ones[p[0]] + 6.6)) for p, n in pairs.items()}
        self.ones = {a: math.log2(0.1 / (n + 6.6)) for a, n in ones.items()}
        self.never = math.log2(0.1 / 6.6)
        self.tables, self.least, self.own = {}, {}, {}
        for kind in sorted(positive):
            table = logs(learn(positive[kind], alpha))
            good = sorted(self._ratio(table, w) for w in positive[kind])
            bad = sorted(self._ratio(table, w) for w in negative)
            if good:
                self.tables[kind] = table
                own = sorted(_likelihood(table, w) / (len(w) + 1) for w in positive[kind])
                self.own[kind] = own[int(keep / 2 * len(own))] - slack
                # ordinary tokens may raise the threshold, but hold unknown credentials themselves: no more than ``most`` of the labels fall under it
                ordinary = min(bad[-1 - len(bad) // 1000] if bad else 0.0, good[int(most * len(good))])
                self.least[kind] = max(0.5, good[int(keep * len(good))], ordinary)

    def _ordinary(self, word: str) -> float:
        return sum(self.pairs.get((a, b)) or self.ones.get(a, self.never) for a, b in zip("^" + word, word + "$"))

    def _ratio(self, table, word: str) -> float:
        """Bits for each letter by which the automaton likes the token more than ordinary text does."""
        return (_likelihood(table, word) - self._ordinary(word)) / (len(word) + 1)

    def score(self, word: str) -> float:
        """Largest margin over a kind's threshold; positive for a credential, -inf if no kind accepts it.

        A kind accepts a token that is nearly as likely, for each letter, as its
        own labels are, and by enough likelier than ordinary text makes it.
        """
        best, ordinary, size = -math.inf, self._ordinary(word), len(word) + 1
        for kind, table in self.tables.items():
            likely = _likelihood(table, word, max(self.own[kind] * size, ordinary + self.least[kind] * size))
            if likely is not None and likely / size >= self.own[kind]:
                best = max(best, (likely - ordinary) / size - self.least[kind])
        return best


def fit(docs: DataFrame, sample_docs: int = 20_000, per_kind: int = 400, ordinary: int = 4_000, longest: int = 4096, generated: int = 200) -> Formats:
    """Learn from a sample: at most about ``sample_docs`` documents, drawn by a hash of their ids.

    Of their base matches at most ``per_kind`` different values of each kind,
    and of their other tokens at most ``ordinary``, both the smallest by hash,
    reach the driver, and whole values of at most ``longest`` letters only. To
    these labels come ``generated`` credentials of each known format. The bounds
    are fixed parameters: the automata do not grow with the corpus. A format that
    makes up several percent of the ordinary tokens drawn counts as ordinary.
    """
    count = docs.count()
    share = min(1.0, sample_docs / max(1, count))
    rows = docs.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def labelled(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            base = base_spans(text or "")
            values = [{"kind": BASE[k], "value": v} for _, k, _, v in base]
            out.append(values + [{"kind": LEARNED, "value": t} for _, _, t, touches in tokens_of(text or "", base) if not touches])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])))

    tokens = rows.select(F.explode(F.arrow_udf(labelled, "array<struct<kind:string,value:string>>")(F.col("text"))).alias("t"))
    tokens = tokens.where(F.length("t.value") <= longest).select("t.kind", "t.value").distinct().withColumn("h", F.xxhash64("value"))
    positive, negative = defaultdict(list), []
    for kind in BASE:
        positive[kind] = [r[0] for r in tokens.where(F.col("kind") == kind).orderBy("h", "value").limit(per_kind).select("value").collect()]
    negative = [r[0] for r in tokens.where(F.col("kind") == LEARNED).orderBy("h", "value").limit(ordinary).select("value").collect()]
    labels = {k: v for k, v in positive.items() if v} | (labelled_formats(generated) if generated else {})
    return Formats(labels, negative)


def scanner(formats: Formats) -> Callable[[Column], Column]:
    """Column function: text to an array of struct(kind, start, end), by start and kind.

    Offsets count code points, the end is exclusive; a null or empty text has
    none. Base matches are as the patterns give them, leftmost and without
    overlaps of the same kind. Added spans are tokens in a learned format that do
    not lie within one base match; they may contain base matches and stand beside them.
    """

    def scan(texts: pa.Array) -> pa.Array:
        known: dict[str, bool] = {}
        kinds, starts, ends, cuts = [], [], [], [0]
        names = (*BASE, LEARNED)
        for text in texts.to_pylist():
            base = base_spans(text) if text else []
            spans = [(s, k, e) for s, k, e, _ in base]
            reached = -1
            for s, e, token, _ in tokens_of(text, base) if text else ():
                if s < reached:
                    continue
                hit = known.get(token)
                if hit is None:
                    hit = formats.score(token) > 0
                    if len(known) < 200_000:
                        known[token] = hit
                if hit:
                    spans.append((s, len(BASE), e))
                    reached = e
            for s, k, e in sorted(spans):
                kinds.append(names[k])
                starts.append(s)
                ends.append(e)
            cuts.append(len(kinds))
        span = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), span)

    return F.arrow_udf(scan, "array<struct<kind:string,start:int,end:int>>").asNondeterministic()


def find_secrets(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """``docs`` with an array column ``__secrets``; without ``formats``, they are learned from ``docs``."""
    formats = formats or fit(docs.select("doc_id", "text"))
    return docs.withColumn("__secrets", scanner(formats)(F.col("text")))
