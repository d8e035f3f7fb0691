"""Secret scans by grammar inference.

Labelled credentials (what the base patterns find in all documents) become a prefix
tree with counts, which Spark takes over the distinct tokens; its states are merged, red-blue fashion, while their outgoing frequencies agree
within a Hoeffding bound, which leaves a probabilistic automaton of the credentials' format. A second
automaton is inferred from ordinary tokens of the same documents, from which tokens that look like
credentials themselves are taken out first, so that an unlabelled secret can't hide its own kind.
Every candidate of every text, which is each run of ``LEAST_CHARS`` or more characters of the
credential alphabet but the dot, is then scored by the mean log-likelihood ratio of the two. Candidates above the
margin are spans of the kind ``format``; base spans are scored too and always stay.

The margin is a quantile of the scores of all ordinary tokens. The automata
read character classes; within a class all characters are equally likely.

Edge cases: a null or empty text has no spans; without a labelled credential nothing is
inferred and only base spans are returned; repeated rows and null ids are kept; an empty table gives
an empty result; other columns are ignored by ``find_secrets`` and kept by ``redact_secrets``.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.llm.common import reliable, sha256_hex, text_or_empty

Span = tuple[int, int]
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "format")
#: Bounds of the fit: prefixes that make states, and characters of a token (a longer one teaches no end).
MOST_PREFIXES, SAMPLE_CHARS = 8_192, 256
#: The shortest credential that a base pattern knows.
LEAST_CHARS = 12
MARGIN_QUANTILE = 0.995


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
_ASSIGN = re.compile(rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
#: No dot: host names and addresses are no credentials, and the parts of a dotted credential are scored one by one.
_CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
_TRIMMED = "=-/_+"
_CLASSES = (("0123456789", "d"), ("abcdef", "h"), ("ghijklmnopqrstuvwxyz", "l"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "u"), ("+/_.=-", "s"))
_CLASS_OF = str.maketrans({c: name for chars, name in _CLASSES for c in chars})
_WITHIN = {name: math.log(len(chars)) for chars, name in _CLASSES}
END = "$"


def base_spans(text: str) -> dict[str, list[Span]]:
    return {
        "assign": [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 12],
        "access": [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= 18],
        "hex": [m.span() for m in _HEX.finditer(text)],
    }


def labelled_tokens(text: str) -> tuple[set[str], set[str]]:
    """Credentials (the values that base spans hold) and ordinary tokens of one text."""
    values = {m[2] for m in _ASSIGN.finditer(text) if len(m[2]) >= 12}
    values |= {m[0] for m in _ACCESS.finditer(text) if len(m[0]) >= 18} | {m[0] for m in _HEX.finditer(text)}
    tokens = set(re.findall("[A-Za-z0-9+/_.=-]{6,}", text))
    return values, {t for t in tokens if not any(v in t for v in values)} if values else tokens


class Automaton:
    """A probabilistic automaton over character classes, inferred by merging compatible states."""

    def __init__(self, words: list[str] = (), alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]
        for word in words:
            state = 0
            for symbol in word[:SAMPLE_CHARS].translate(_CLASS_OF):
                self.count[state][symbol] += 1
                state = self._child(state, symbol)
            if len(word) <= SAMPLE_CHARS:
                self.count[state][END] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._take_logs()

    @classmethod
    def of_counts(cls, prefixes: dict[str, int]) -> Automaton:
        """Inferred from counted prefixes (class strings, whole ones with ``END``); a prefix whose own successors are left out is a leaf."""
        made = cls()
        inner = {p[:-1] for p in prefixes}
        places = {"": 0}
        for prefix in sorted(prefixes, key=lambda p: (len(p), p)):
            parent = places[prefix[:-1]]
            made.count[parent][prefix[-1]] += prefixes[prefix]
            if prefix in inner:
                places[prefix] = made._child(parent, prefix[-1])
        made._merge_states()
        made._take_logs()
        return made

    def _child(self, state: int, symbol: str) -> int:
        if symbol not in self.next[state]:
            self.next[state][symbol] = len(self.next)
            self.next.append({})
            self.count.append(defaultdict(int))
        return self.next[state][symbol]

    def steps(self, symbols: str) -> Iterator[tuple[int, str]]:
        """The states that a class string passes (an unknown path restarts) and the symbols read there, ``END`` included."""
        state = 0
        for symbol in symbols:
            yield state, symbol
            state = self.next[state].get(symbol, 0)

    def _take_logs(self) -> None:
        self.logs = []
        for counts in self.count:
            total = sum(counts.values()) + 0.5 * (len(_CLASSES) + 1)
            self.logs.append({s: math.log((counts.get(s, 0) + 0.5) / total) for s in (*_WITHIN, END)})

    def recount(self, counts: dict[tuple[int, str], int]) -> None:
        """Put counted steps of whole words in place of the prefixes' counts."""
        self.count = [defaultdict(int) for _ in self.next]
        for (state, symbol), n in counts.items():
            self.count[state][symbol] = n
        self._take_logs()

    def _close(self, a: int, b: int) -> bool:
        """Whether the subtree of ``b`` is statistically compatible with the automaton at ``a``."""
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            n, m = sum(self.count[x].values()), sum(self.count[y].values())
            if not n or not m:
                continue
            room = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for symbol in {*self.count[x], *self.count[y]}:
                if abs(self.count[x].get(symbol, 0) / n - self.count[y].get(symbol, 0) / m) > room:
                    return False
            stack += [(self.next[x][s], t) for s, t in self.next[y].items() if s in self.next[x]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the automaton at ``a``."""
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            for symbol, n in self.count[y].items():
                self.count[x][symbol] += n
            for symbol, target in self.next[y].items():
                if symbol in self.next[x]:
                    stack.append((self.next[x][symbol], target))
                else:
                    self.next[x][symbol] = target

    def _merge_states(self) -> None:
        red = [0]
        blue = [(0, s) for s in sorted(self.next[0])]
        while blue:
            parent, symbol = blue.pop(0)
            state = self.next[parent][symbol]
            if state in red:
                continue
            into = next((r for r in red if self._close(r, state)), None)
            if into is None:
                red.append(state)
                blue += [(state, s) for s in sorted(self.next[state])]
            else:
                self.next[parent][symbol] = into
                self._fold(into, state)
                blue = [(r, s) for r in red for s in sorted(self.next[r]) if self.next[r][s] not in red]

    def log_likelihood(self, word: str) -> float:
        """Mean log-likelihood of a character, the word's end included; an unknown path restarts."""
        return self.symbols_likelihood(word.translate(_CLASS_OF))

    def symbols_likelihood(self, symbols: str) -> float:
        state, total = 0, 0.0
        for symbol in symbols:
            total += self.logs[state][symbol] - _WITHIN[symbol]
            state = self.next[state].get(symbol, 0)
        return (total + self.logs[state][END]) / (len(symbols) + 1)


class Grammar:
    """Credentials against ordinary tokens; ``margin`` is the least score of a span."""

    def __init__(self, credentials: list[str], ordinary: list[str], unseen: list[str] | None = None, margin: float = 0.0):
        self.credential = Automaton(credentials)
        # What a first draft takes for credentials is no ordinary token; plain words are never in doubt.
        self.ordinary = Automaton([w for w in ordinary if w.isalpha()])
        self.memory: dict[str, float] = {}
        plain = [w for w in ordinary if w.isalpha() or self.score(w) <= margin]
        self.ordinary = Automaton(plain)
        self.memory.clear()
        unseen = plain if unseen is None else [w for w in unseen if w.isalpha() or self.score(w) <= margin]
        scores = sorted(self.score(w) for w in unseen if len(w) >= LEAST_CHARS)
        self.margin = max(margin, scores[int(MARGIN_QUANTILE * (len(scores) - 1))]) if scores else margin
        self.memory.clear()

    @classmethod
    def of_automata(cls, credential: Automaton, ordinary: Automaton, margin: float = 0.0) -> Grammar:
        made = cls.__new__(cls)
        made.credential, made.ordinary, made.margin, made.memory = credential, ordinary, margin, {}
        return made

    def score_symbols(self, symbols: str) -> float:
        """The score of every token of one class string."""
        return self.credential.symbols_likelihood(symbols) - self.ordinary.symbols_likelihood(symbols)

    def score(self, token: str) -> float:
        known = self.memory.get(token)
        if known is None:
            if len(self.memory) > 100_000:
                self.memory.clear()
            known = self.memory[token] = self.credential.log_likelihood(token) - self.ordinary.log_likelihood(token)
        return known


def class_strings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``good`` (a credential), ``symbols`` (a class string) and ``n`` (distinct tokens that have it) of all tokens of all documents."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for body in batch.column(0).to_pylist():
                good, plain = labelled_tokens(body)
                rows |= {(t, True) for t in good} | {(t, False) for t in plain}
            ordered = sorted(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in ordered], pa.string()), pa.array([g for _, g in ordered], pa.bool_())], ["token", "good"]
            )

    found = docs.select(text_or_empty(text_col).alias("__text")).mapInArrow(tokens, "token string, good boolean").distinct()
    chars, names = "".join(c for c, _ in _CLASSES), "".join(n * len(c) for c, n in _CLASSES)
    return reliable(found.groupBy("good", F.translate("token", chars, names).alias("symbols")).agg(F.count(F.lit(1)).alias("n")))


def infer_automaton(words: DataFrame, most: int = MOST_PREFIXES) -> Automaton:
    """States from the ``most`` most frequent prefixes of ``symbols`` (with ``n``), frequencies from every token.

    Frequencies of rarer prefixes decide no merge. If any prefix was left out, all class strings are read by
    the automaton and its frequencies counted anew. At most 7 numbers a prefix or state reach the driver.
    """
    whole = F.when(F.length("symbols") <= SAMPLE_CHARS, F.concat("symbols", F.lit(END))).otherwise(F.substring("symbols", 1, SAMPLE_CHARS))
    ended = words.select(whole.alias("w"), "n")
    prefix = F.transform(F.sequence(F.lit(1), F.length("w")), lambda k: F.substring(F.col("w"), F.lit(1), k))
    counted = reliable(ended.select(F.explode(prefix).alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n")))
    rows = counted.orderBy(F.desc("n"), "p").limit(most + 1).collect()
    if len(rows) <= most:
        return Automaton.of_counts({r["p"]: r["n"] for r in rows})
    kept = {r["p"] for r in rows if r["n"] > rows[-1]["n"]}  # closed: what a prefix begins with is at least as frequent
    parents = words.sparkSession.createDataFrame([(p,) for p in ("", *sorted(kept))], "parent string")
    parent = F.expr("substring(p, 1, length(p) - 1)")
    fringe = counted.join(F.broadcast(parents), parent == F.col("parent"), "left_semi").collect()
    made = Automaton.of_counts({r["p"]: r["n"] for r in fringe})
    shared = words.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, str], int] = defaultdict(int)
        for batch in batches:
            for symbols, n in zip(*(c.to_pylist() for c in batch.columns)):
                for step in shared.value.steps(symbols):
                    total[step] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in total], pa.int64()), pa.array([c for _, c in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["state", "symbol", "n"]
        )

    steps = ended.mapInArrow(run, "state long, symbol string, n long").groupBy("state", "symbol").agg(F.sum("n").alias("n"))
    made.recount({(r["state"], r["symbol"]): r["n"] for r in steps.collect()})
    return made


def _scored(words: DataFrame, grammar: Grammar) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("score", pa.array([shared.value.score_symbols(s) for s in batch.column(0).to_pylist()], pa.float64()))

    return words.select("symbols", "n").mapInArrow(run, "symbols string, n long, score double")


def weighted_quantile(scores: DataFrame, quantile: float, cells: tuple[int, ...] = (100, 100_000, 100_000_000)) -> float | None:
    """The largest ``score`` in the cell of 1e-8 that holds the element ``int(quantile * (n - 1))`` of all, ``n`` being weights.

    Finer cells are counted within the one that holds the rank, so about a thousand numbers reach the driver a step.
    """
    rows, below, rank = scores, 0, None
    for k, cell in enumerate(cells):
        at = F.floor(F.col("score") * cell)
        counts = sorted(rows.groupBy(at.alias("c")).agg(F.sum("n").alias("n"), F.max("score").alias("top")).collect())
        if not counts:
            return None
        rank = int(quantile * (sum(r["n"] for r in counts) - 1)) if rank is None else rank
        for found in counts:
            if below + found["n"] > rank:
                break
            below += found["n"]
        rows = rows.filter(at == found["c"])
    return found["top"]


def infer_grammar(docs: DataFrame, text_col: str = "text", margin: float = 0.0, most: int = MOST_PREFIXES) -> Grammar | None:
    """Fit on the distinct tokens of all documents: automata, and the margin from every ordinary token that a candidate could be."""
    words = class_strings(docs, text_col)
    good, ordinary = words.filter("good"), words.filter("NOT good")
    if not good.limit(1).count():
        return None
    credential = infer_automaton(good, most)
    alpha = F.col("symbols").rlike("^[hlu]*$")
    # What a first draft takes for credentials is no ordinary token; plain words are never in doubt.
    draft = Grammar.of_automata(credential, infer_automaton(ordinary.filter(alpha), most))
    plain = reliable(_scored(ordinary, draft).filter(alpha | (F.col("score") <= margin)).select("symbols", "n"))
    made = Grammar.of_automata(credential, infer_automaton(plain, most), margin)
    top = weighted_quantile(reliable(_scored(plain.filter(F.length("symbols") >= LEAST_CHARS), made)), MARGIN_QUANTILE)
    made.margin = margin if top is None else max(margin, top)
    return made


@dataclass
class Scan:
    """What one text holds: spans by kind, how many candidates were scored, and how many base spans have the format."""

    spans: dict[str, list[Span]]
    candidates: int = 0
    likely: int = 0


def scan(text: str, grammar: Grammar | None) -> Scan:
    """Base spans, and ``format`` spans: candidates that look like credentials and touch no base span."""
    spans = base_spans(text)
    found = Scan({**spans, "format": []})
    if grammar is None:
        return found
    values = [text[_ASSIGN.match(text, s).start(2) : e] for s, e in spans["assign"]]
    values += [text[s:e] for kind in ("access", "hex") for s, e in spans[kind]]
    found.likely = sum(grammar.score(v) > grammar.margin for v in values)
    taken = sorted(s for own in spans.values() for s in own)
    at = 0
    for m in _CANDIDATE.finditer(text):
        token = m[0].strip(_TRIMMED)
        if len(token) < LEAST_CHARS:
            continue
        found.candidates += 1
        if grammar.score(token) <= grammar.margin:
            continue
        start = m.start() + m[0].index(token)
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= start + len(token):
            found.spans["format"].append((start, start + len(token)))
    return found


def secret_spans(text: str, grammar: Grammar | None) -> dict[str, list[Span]]:
    return scan(text, grammar).spans


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the order of ``kinds``, joined by commas."""
    order = sorted((s, n, e) for n, kind in enumerate(kinds) for s, e in spans[kind])
    return ",".join(f"{kinds[n]}:{s}:{e}" for s, n, e in order)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.0) -> DataFrame:
    """Per row: ``id_col``, counts of the base kinds, ``base_sha256``, ``spans``, ``n_format`` (spans that the
    grammar adds), ``n_candidates`` (tokens scored) and ``n_likely`` (base spans of the inferred format)."""
    shared = docs.sparkSession.sparkContext.broadcast(infer_grammar(docs, text_col, margin))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            scans = [scan(t, grammar) for t in batch.column(1).to_pylist()]
            found = [s.spans for s in scans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([len(f[kind]) for f in found], pa.int64()) for kind in BASE),
                    pa.array([sha256_hex(joined(f, BASE).encode()) for f in found], pa.string()),
                    pa.array([joined(f, KINDS) for f in found], pa.string()),
                    pa.array([len(f["format"]) for f in found], pa.int64()),
                    pa.array([s.candidates for s in scans], pa.int64()),
                    pa.array([s.likely for s in scans], pa.int64()),
                ],
                [id_col, *(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "n_format", "n_candidates", "n_likely"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run,
        f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string, n_format long, n_candidates long, n_likely long",
    )


def redacted(text: str, grammar: Grammar | None, mark: str = "[SECRET]") -> str:
    """``text`` with every span replaced; of an assignment only the value goes, the keyword stays."""
    spans = secret_spans(text, grammar)
    cuts = [_ASSIGN.match(text, s).span(2) for s, _ in spans["assign"]]
    cuts = sorted(cuts + spans["access"] + spans["hex"] + spans["format"])
    out, at = [], 0
    for s, e in cuts:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", margin: float = 0.0
) -> DataFrame:
    """All rows and columns, with secrets cut out of the texts and the length column brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(infer_grammar(docs, text_col, margin))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            texts = [None if t is None else redacted(t, grammar) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    clean = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        size = F.length(text_col).cast(docs.schema[length_col].dataType)
        clean = clean.withColumn(length_col, F.when(F.col(text_col).isNotNull(), size).otherwise(F.col(length_col)))
    return clean
