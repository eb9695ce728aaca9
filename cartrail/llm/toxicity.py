"""Toxicity: a learned lexicon as a trie, met by Levenshtein automata, and a score of each hit's context.

The lexicon, the tokens that only look like its terms, and the weights are learned from labelled documents. All
else runs over every document: the trie and the Levenshtein automata of its terms are made deterministic
together, so a token is read once, character by character, and most leave the automaton after a few.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import boxed, hash_key, map_texts, settled, ship, unboxed

#: labelled documents that the lexicon and the weights are learned from, at most; chosen by a hash of the id
TRAIN_ROWS = 6000
#: a term must be in so many toxic documents, and in so few others per toxic one; its log-likelihood ratio must be
#: so high, and so high that of the keys that pass, this share at most is expected there by chance
LEAST_DOCS, CLEAN_SHARE, LEAST_G, CHANCE = 4, 0.05, 15.0, 0.05
#: smallest hashes by which near copies among the training documents are found, and how many must agree: most
MARKS, AGREEING = 32, 17
#: odd factors that make one hash many
FACTORS = np.random.default_rng(7).integers(0, 2**63, MARKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEMS = range(3, 7)
#: states of an automaton that a worker keeps; with more it starts anew
STATES = 50_000
#: characters to either side of a hit that tell quotation from abuse
CONTEXT = 60
LIMIT = 0.7
TOKEN = re.compile(r"[^\W_]+")
OPENING, CLOSING = '"“„«‹‘', '"”“»›’'
#: words of reporting and of address (fixed values)
REPORTING = frozenset(
    "said says called calls wrote writes quoted quote term word dit appelle mot sagte nannte wort dijo llama palabra".split()
)
ADDRESS = frozenset("you your youre u tu vous toi votre du dich dein ihr usted eres vosotros".split())
FEATURES = ("abuse", "fuzzy", "quoted", "directed")
#: a misspelled term counts for so much of an exact one; the weight of ``fuzzy`` corrects it by what labels say
MISSPELLED = 0.8
#: where the weights start from and are drawn to: the bias, then FEATURES
PRIOR = (-3.0, 3.0, 0.0, 0.0, 0.5)


def edits_allowed(term: str, stem: bool) -> int:
    """How far a token may be from a term, or its beginning from a stem: long words are met at up to two edits."""
    if stem:
        return 0 if len(term) < 5 else 1
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """The Levenshtein automata of all terms over their trie, made deterministic as far as texts need it.

    A state is a set of (trie node, edits so far). Reading a character follows the trie, or spends an edit on
    another character, an extra one, or a skipped one; nodes below which no term allows so many edits are left
    out. The states are sets over a lexicon of fixed size, and characters outside it are one symbol.
    """

    OTHER = "\0"

    def __init__(self, terms: Sequence[tuple[str, bool]], worths: Sequence[float] = ()) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.allowed = [0]
        self.ends: dict[int, int] = {}
        self.stems: dict[int, int] = {}
        self.terms: dict[tuple[int, bool], tuple[float, int]] = {}
        for number, ((term, stem), worth) in enumerate(zip(terms, worths or [1.0] * len(terms), strict=True)):
            node, most = 0, edits_allowed(term, stem)
            self.allowed[0] = max(self.allowed[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], most)
            (self.stems if stem else self.ends)[node] = most
            self.terms[node, stem] = (-worth, number)
        self.alphabet = {c for node in self.children for c in node}
        self.begin()

    def begin(self) -> None:
        """Forget all states but the first; texts bring back those that they need."""
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.sets: list[frozenset[tuple[int, int]]] = []
        self.numbers: dict[frozenset[tuple[int, int]], int] = {}
        self._state({(0, 0)} if self.terms else set())

    def _state(self, found: set[tuple[int, int]]) -> int:
        """The number of the state with these members and those that skipping characters of terms adds."""
        waiting = list(found)
        while waiting:
            node, edits = waiting.pop()
            for child in self.children[node].values():
                if edits < self.allowed[child] and (child, edits + 1) not in found:
                    found.add((child, edits + 1))
                    waiting.append((child, edits + 1))
        members = frozenset(found)
        if not members:
            return -1
        if members not in self.numbers:
            self.numbers[members] = len(self.sets)
            self.sets.append(members)
            self.steps.append({})
            # a stem is met as soon as it is read; a word at its end
            met = [(e, self.terms[n, True]) for n, e in members if n in self.stems and e <= self.stems[n]]
            met += [(e, self.terms[n, False]) for n, e in members if n in self.ends and e <= self.ends[n]]
            self.accepts.append((min(met)[0], min(met)[1][1]) if met else None)
        return self.numbers[members]

    def _step(self, state: int, c: str) -> int:
        moved = set()
        for node, edits in self.sets[state]:
            if node in self.stems and edits <= self.stems[node]:
                moved.add((node, edits))  # whatever follows a stem
            for letter, child in self.children[node].items():
                if letter == c:
                    moved.add((child, edits))
                elif edits < self.allowed[child]:
                    moved.add((child, edits + 1))
            if edits < self.allowed[node]:
                moved.add((node, edits + 1))
        following = self.steps[state][c] = self._state(moved)
        return following

    def match(self, token: str) -> int | None:
        """The fewest edits from ``token`` to a term that allows them, or None."""
        met = self.meet(token)
        return met[0] if met else None

    def meet(self, token: str) -> tuple[int, int] | None:
        """The fewest edits from ``token`` to a term that allows them, and the number of the worthiest such term."""
        if not self.steps:
            return None
        if len(self.sets) > STATES:
            self.begin()
        state, steps, alphabet = 0, self.steps, self.alphabet
        for c in token:
            if c not in alphabet:
                c = self.OTHER
            following = steps[state].get(c)
            if following is None:
                following = self._step(state, c)
            if following < 0:
                return None
            state = following
        return self.accepts[state]


@dataclass(frozen=True)
class Model:
    """What is learned: terms with whether they are stems, tokens that only look like one, and weights.

    ``covered`` are words that begin with a stem of ``terms``; they are terms of their own where they are misspelled.
    ``worths`` has what a hit of each term counts, then of each covered word, and ``misspelled`` what it counts with
    edits; without them, all count 1.
    """

    terms: tuple[tuple[str, bool], ...] = ()
    harmless: frozenset[str] = frozenset()
    weights: tuple[float, ...] = PRIOR
    worths: tuple[float, ...] = ()
    covered: tuple[str, ...] = ()
    misspelled: tuple[float, ...] = ()
    _automata: list = field(default_factory=list, compare=False, repr=False)

    @property
    def automaton(self) -> LexiconAutomaton:
        if not self._automata:
            if self not in _built:
                _built.clear()
                _built[self] = LexiconAutomaton([*self.terms, *((w, False) for w in self.covered)], self.worths)
            self._automata.append(_built[self])
        return self._automata[0]


#: the automaton of the model that a worker met last; a worker outlives its tasks, which bring copies of the model
_built: dict[Model, LexiconAutomaton] = {}


def hits(model: Model, lowered: str) -> dict[str, tuple[int, int]]:
    """The tokens of a text that meet the lexicon, with their edits and the term's number."""
    meet, harmless = model.automaton.meet, model.harmless
    found = {}
    for token in set(TOKEN.findall(lowered)):
        met = meet(token)
        if met is not None and (met[0] == 0 or token not in harmless):
            found[token] = met
    return found


def quoted(before: str, after: str) -> bool:
    """Whether a hit stands in quotation marks or after a word of reporting."""
    opened = [before.rfind(c) for c in OPENING]
    closed = max(before.rfind(c) for c in "”»›")
    marks = max(opened) > closed and any(c in after for c in CLOSING)
    if marks and before.count('"') % 2 == 0 and max(opened) == before.rfind('"'):
        marks = False
    return marks or not REPORTING.isdisjoint(TOKEN.findall(before)[-3:])


def told_hits(model: Model, text: str | None) -> Iterator[tuple[str, float, bool]]:
    """Each hit of a text: exact, fuzzy or quoted, what its term is worth, and whether a word of address is near."""
    lowered = (text or "").lower()
    found = hits(model, lowered)
    if found:
        for token in TOKEN.finditer(lowered):
            if token.group() not in found:
                continue
            edits, number = found[token.group()]
            known = model.misspelled if edits else model.worths
            worth = known[number] if known else 1.0
            before = lowered[max(0, token.start() - CONTEXT) : token.start()]
            after = lowered[token.end() : token.end() + CONTEXT]
            if quoted(before, after):
                yield "quoted", worth, False
            else:
                directed = not ADDRESS.isdisjoint(TOKEN.findall(before)[-4:] + TOKEN.findall(after)[:2])
                yield "fuzzy" if edits else "exact", worth, directed


def count_hits(model: Model, text: str | None) -> dict[str, int]:
    """How many hits are exact, fuzzy, quoted, and near a word of address; quoted ones are neither of the others."""
    counts = dict.fromkeys(("exact", "fuzzy", "quoted", "directed"), 0)
    for kind, _, directed in told_hits(model, text):
        counts[kind] += 1
        counts["directed"] += directed
    return counts


def features(model: Model, text: str | None) -> tuple[float, ...]:
    """Logarithms of the sums over hits, each counting what its term is worth, as the weights take them."""
    n = dict.fromkeys(("exact", "fuzzy", "quoted", "directed"), 0.0)
    for kind, worth, directed in told_hits(model, text):
        n[kind] += worth
        n["directed"] += worth * directed
    return tuple(math.log1p(v) for v in (n["exact"] + MISSPELLED * n["fuzzy"], n["fuzzy"], n["quoted"], n["directed"]))


def logistic(weights: Sequence[float], x: np.ndarray) -> np.ndarray:
    z = weights[0] + x @ np.asarray(weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, prior: Sequence[float] = PRIOR, rounds: int = 30) -> tuple[float, ...]:
    """Logistic regression by Newton's method, with a normal prior of unit variance around ``prior``."""
    mean = np.asarray(prior)
    w = mean.copy()
    wide = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        gradient = wide.T @ (p - y) + (w - mean)
        curvature = (wide * (p * (1 - p))[:, None]).T @ wide + np.eye(len(w))
        w = w - np.linalg.solve(curvature, gradient)
    return tuple(float(v) for v in w)


def term_keys(text: str | None) -> set[str]:
    """What a document supports: its words, marked by an end sign, and their stems."""
    tokens = {t for t in TOKEN.findall((text or "").lower()) if len(t) > 2}
    keys = {t + "$" for t in tokens}
    for n in STEMS:
        keys.update([t[:n] for t in tokens if len(t) >= n])
    return keys


def surprise(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """The log-likelihood ratio of a term's counts against equal rates."""
    total, both = toxic + clean, all_toxic + all_clean
    due = total * all_toxic / both, total * all_clean / both
    return 2 * sum(n * math.log(n / d) for n, d in zip((toxic, clean), due, strict=True) if n)


def least_surprise(ratios: Sequence[float], keys: int) -> float:
    """The ratio from which ``CHANCE`` of the passing keys at most are due to chance, of ``keys`` that were looked at.

    Benjamini and Hochberg's rule; a ratio has nearly the distribution of a squared normal number.
    """
    ordered = sorted(ratios, reverse=True)
    passing = [g for n, g in enumerate(ordered, 1) if math.erfc(math.sqrt(max(g, 0) / 2)) * keys <= CHANCE * n]
    return max(LEAST_G, min(passing, default=math.inf))


def worth(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """The logarithm of the ratio of a term's rates, drawn to 0 by half a document on each side."""
    return max(0.0, math.log((toxic + 0.5) * (all_clean + 1) / ((clean + 0.5) * (all_toxic + 1))))


def misspelled_worth(exact: tuple[int, int], met: tuple[int, int], all_toxic: int, all_clean: int) -> float:
    """The same of a term's misspellings, from the documents they are in, drawn to the term's own as by one toxic document."""
    ratio = (met[0] + 1) / (met[1] + (exact[1] + 0.5) / (exact[0] + 0.5))
    return max(0.0, math.log(ratio * (all_clean + 1) / (all_toxic + 1)))


def marking_keys(counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int, keys: int | None = None) -> dict[str, int]:
    """The keys that mark toxic documents, with how many of these they are in.

    What a key needs is support, not a share of the documents: words of a small group are in a small share.
    ``keys`` is the number of keys that ``counts`` were chosen from.
    """
    likely = {
        key: surprise(toxic, clean, all_toxic, all_clean)
        for key, (toxic, clean) in counts.items()
        if toxic >= LEAST_DOCS and clean / max(all_clean, 1) <= CLEAN_SHARE * toxic / max(all_toxic, 1)
    }
    least = least_surprise(list(likely.values()), len(counts) if keys is None else keys)
    return {key: counts[key][0] for key, ratio in likely.items() if ratio >= least}


def choose_terms(
    counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int, keys: int | None = None
) -> list[tuple[str, bool]]:
    """Terms that mark toxic documents, from documents by key: the shortest that say all their extensions say.

    A stem whose next longer key has nearly its count says nothing by itself, and the longer one is taken. Keys
    that begin with a chosen stem add nothing.
    """
    good = marking_keys(counts, all_toxic, all_clean, keys)
    longer: dict[str, int] = {}
    for key, toxic in good.items():
        stem = key[: min(len(key) - 1, STEMS[-1])]
        longer[stem] = max(longer.get(stem, 0), toxic)
    chosen: list[tuple[str, bool]] = []
    stems: list[str] = []
    for key in sorted(good, key=lambda k: (len(k.rstrip("$")), k.endswith("$"), k)):
        word = key.rstrip("$")
        if any(word.startswith(s) for s in stems):
            continue
        if key.endswith("$"):
            chosen.append((word, False))
        elif longer.get(key, 0) < 0.9 * good[key]:
            stems.append(key)
            chosen.append((key, True))
    return chosen


def covered_words(
    counts: dict[str, tuple[int, int]], terms: Sequence[tuple[str, bool]], all_toxic: int, all_clean: int, keys: int | None = None
) -> list[str]:
    """The words that mark toxic documents but are not among ``terms``, as a stem has them; misspelled, it may not."""
    stems = tuple(term for term, stem in terms if stem)
    words = [key[:-1] for key in marking_keys(counts, all_toxic, all_clean, keys) if key.endswith("$")]
    return sorted(w for w in words if w.startswith(stems) and edits_allowed(w, False))


def sketch(text: str | None) -> list[int]:
    """The smallest hashes of a text's runs of three tokens; of two texts, they agree as often as the runs do."""
    tokens = TOKEN.findall((text or "").lower())
    runs = {" ".join(tokens[i : i + 3]).encode() for i in range(max(1, len(tokens) - 2))}
    hashed = np.array([zlib.crc32(run) + 1 for run in runs], dtype=np.uint64)
    return [int((hashed * factor >> np.uint64(32)).min()) for factor in FACTORS]


def distinct_sketches(sketches: np.ndarray) -> list[int]:
    """The rows that are no near copy of an earlier row that stays."""
    kept = np.empty_like(sketches)
    places: list[int] = []
    for place, row in enumerate(sketches):
        if not ((kept[: len(places)] == row).sum(axis=1) >= AGREEING).any():
            kept[len(places)] = row
            places.append(place)
    return places


def training_documents(docs: DataFrame, labels: DataFrame, rows: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, toxic, text`` of at most ``rows`` labelled documents, without near copies of each other.

    An id that is labelled twice counts as toxic if one label says so; of rows with one id, one is taken.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(hash_key("train", F.col("doc_id")), "doc_id").limit(rows)
    held = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # at most ``rows`` pairs of numbers
    joined = held.join(F.broadcast(settled(chosen)), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    joined = settled(joined)

    def work(texts: list[str | None]) -> dict[str, list]:
        return {"sketch": [sketch(t) for t in texts]}

    marked = map_texts(joined, [F.col("doc_id"), (F.col("toxic") > 0).alias("toxic")], "text", work, "sketch array<bigint>")
    # at most ``rows`` lists of ``MARKS`` numbers come here, and all pairs of one label are compared
    found = marked.orderBy("toxic", "doc_id").collect()
    different = []
    for label in (False, True):
        same = [r for r in found if r["toxic"] == label]
        sketches = np.array([r["sketch"] for r in same], dtype=np.int64).reshape(len(same), MARKS)
        different += [(same[place]["doc_id"],) for place in distinct_sketches(sketches)]
    ids = docs.sparkSession.createDataFrame(different, marked.select("doc_id").schema)
    return joined.join(F.broadcast(ids), "doc_id", "left_semi")


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from ``labels (doc_id, toxic)`` and the documents they belong to.

    At most ``rows`` labelled documents are used, the bound of what comes to the driver here: counts of the keys
    that enough of them support, and a few numbers for each document. Without labels of both kinds the model knows no
    terms, and every document gets the score of the prior.
    """
    ship(docs.sparkSession)
    sample = settled(training_documents(docs, labels, rows, doc_id, text))
    sizes = dict(sample.groupBy("toxic").agg(F.count(F.lit(1))).collect())
    all_toxic, all_clean = sum(n for t, n in sizes.items() if t > 0), sum(n for t, n in sizes.items() if t <= 0)
    if not all_toxic or not all_clean:
        return Model()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(term_keys(content))
                yield pa.RecordBatch.from_pydict({"key": pa.array(found, pa.string()), "toxic": pa.array([toxic > 0] * len(found), pa.bool_())})

    counted = sample.select("toxic", "text").mapInArrow(keys, "key string, toxic boolean")
    counts = counted.groupBy("key").agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"))
    counts = settled(counts.where(F.col("toxic") + F.col("clean") >= LEAST_DOCS))
    strong = counts.where((F.col("toxic") >= LEAST_DOCS) & (F.col("clean") * all_toxic <= F.col("toxic") * (CLEAN_SHARE * all_clean)))
    # keys of the sample that are in ``LEAST_DOCS`` of its toxic documents, all of them
    listed = {r["key"]: (r["toxic"], r["clean"]) for r in sorted(strong.collect(), key=lambda r: r["key"])}
    sizes = all_toxic, all_clean, counts.count()
    terms = tuple(choose_terms(listed, *sizes))
    covered = tuple(covered_words(listed, terms, *sizes))
    keys_met = [t if stem else t + "$" for t, stem in terms] + [w + "$" for w in covered]
    worths = [worth(*listed[key], all_toxic, all_clean) for key in keys_met]
    most = max(worths, default=1.0)
    worths = tuple(w / most for w in worths)
    raw = Model(terms, worths=worths, covered=covered)

    def fuzzy(texts: list[str | None]) -> dict[str, list]:
        found = [[(t, n) for t, (e, n) in hits(raw, (x or "").lower()).items() if e] for x in texts]
        return {"tokens": [[t for t, _ in f] for f in found], "numbers": [[n for _, n in f] for f in found]}

    seen = map_texts(sample, [F.col("toxic"), F.col("doc_id")], "text", fuzzy, "tokens array<string>, numbers array<int>")
    each = settled(seen.select("toxic", "doc_id", F.explode(F.arrays_zip("tokens", "numbers")).alias("m")).select("toxic", "doc_id", "m.*"))
    times = dict(each.where("toxic <= 0").groupBy("tokens").count().collect())
    harmless = frozenset(times)
    # a clean document is judged by what the others show, as a new one will be; else no misspelled hit in it would count
    others = frozenset(t for t, n in times.items() if n > 1)
    clean_times = each.where("toxic <= 0").groupBy("tokens").agg(F.count(F.lit(1)).alias("times"))
    left = each.join(clean_times, "tokens", "left").where("times is null or (times = 1 and toxic <= 0)")
    documents = left.select("toxic", "doc_id", "numbers").distinct().groupBy("numbers")
    met = {r[0]: (r[1], r[2]) for r in documents.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).collect()}
    misspelled = tuple(
        misspelled_worth(listed[key], met.get(n, (0, 0)), all_toxic, all_clean) / most for n, key in enumerate(keys_met)
    )

    def counted_by(model: Model) -> Callable[[list[str | None]], dict[str, list]]:
        def count(texts: list[str | None]) -> dict[str, list]:
            found = [features(model, t) for t in texts]
            return {name: [f[i] for f in found] for i, name in enumerate(FEATURES)}

        return count

    made = ", ".join(f"{name} double" for name in FEATURES)
    rows_found = []
    for chosen, known in (("toxic > 0", harmless), ("toxic <= 0", others)):
        work = counted_by(Model(terms, known, worths=worths, covered=covered, misspelled=misspelled))
        rows_found += map_texts(sample.where(chosen), [F.col("toxic")], "text", work, made).collect()
    x = np.array([r[1:] for r in rows_found], dtype=float).reshape(len(rows_found), len(FEATURES))
    y = np.array([r[0] > 0 for r in rows_found], dtype=float)
    order = np.lexsort((y, *x.T))  # sums don't depend on the order in which tasks end
    return Model(terms, harmless, fit(x[order], y[order]), worths, covered, misspelled)


def score(docs: DataFrame, model: Model, kept: Sequence[Column], text: str = "text") -> DataFrame:
    """``kept`` columns of every document with ``toxicity`` from 0 to 1.

    The score is made from the text alone. NULL and empty texts have no hits and get the score of a text
    without any; equal texts get equal scores; rows are neither moved nor dropped.
    """

    def work(texts: list[str | None]) -> dict[str, list]:
        x = np.array([features(model, t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return {"toxicity": logistic(model.weights, x).tolist()}

    return map_texts(docs, kept, text, work, "toxicity double")


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document must not be learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def drop_toxic(docs: DataFrame, model: Model, limit: float = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` without those whose score is at ``limit`` or above; the columns stay as they are."""
    boxes = docs.select(boxed(docs).alias("__doc"), F.col(f"`{text}`").alias("__content"))
    scored = score(boxes, model, [F.col("__doc")], "__content")
    return scored.where(F.col("toxicity") < limit).select(*unboxed(docs, "__doc"))
