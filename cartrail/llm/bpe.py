"""BPE encoding and decoding by a deterministic automaton compiled from the merges.

The automaton reads tokens. At first it has one state and an arc for each byte. The gadget of a merge (u, v) -> w
adds to every state that has an arc u an arc w, leading where v led after u, and takes the arc v from the state
that u leads to. Where an arc leads depends on its token alone, so there is one state per token besides the start,
and it is enough to record of each gadget what it took and what it copied: ``MergeAutomaton.arc`` then gives any
entry of the transition table, which is filled as entries are needed. A sequence of tokens is the encoding of its
text exactly if the automaton has the path.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import map_texts

#: the white space of Unicode
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: letters and numbers that came after Unicode 16, as ranges of code points (fixed values); the vocabulary's own
#: library takes them for symbols
NEWER = (
    "0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf "
    "10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 "
    "16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 "
    "1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 "
    "1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)


def ranges(listed: str) -> str:
    """Hexadecimal code points and ranges as the inside of a character class."""
    return "".join("-".join(f"\\U{int(end, 16):08x}" for end in item.split("-")) for item in listed.split())


def splitter(letter: str, number: str, other: str) -> str:
    """How a byte-level vocabulary splits text before merging (a fixed value), for given classes."""
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


#: entries of a worker's tables of transitions and beginnings, and of each half of its table of words; a full one
#: is emptied, so a worker's memory does not grow with what it reads
TABLE, BEGINNINGS = 1 << 18, 1 << 18
WORDS = 1 << 18
#: bytes of a word that a beginning is told by
NEAR = 7
#: all code points below it were assigned long ago
LOW = 0x500


@dataclass(frozen=True)
class Vocabulary:
    """Merges in order as pairs of byte strings, ids by byte string, and special strings that are one token."""

    merges: tuple[tuple[bytes, bytes], ...]
    ids: dict[bytes, int]
    special: dict[str, int]


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves, the other bytes for the characters from 256 on, in turn.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> Vocabulary:
    """A tokenizer file with byte-level pre-splitting and merges; anything it doesn't implement is refused."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, split = held["model"], held["pre_tokenizer"] or {}
    if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
        raise ValueError("not a byte-level BPE vocabulary without prefix space")
    if held["normalizer"] or not split.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("normalizers, whole-word shortcuts and dropout are not implemented")
    added = held["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
        raise ValueError("special tokens must match their string and nothing else")
    signs = byte_signs()
    special = {t["content"]: t["id"] for t in added}

    def raw(token: str) -> bytes:
        return bytes(signs[c] for c in token)

    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    return Vocabulary(tuple((raw(u), raw(v)) for u, v in merges), ids, special)


class MergeAutomaton:
    """States are the start and each token's; ``arc`` is their transition table, filled when asked."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ids = {bytes([b]): vocabulary.ids[bytes([b])] for b in range(256)}
        #: when a token's arcs were made: bytes at the start, others by their merge
        self.born = dict.fromkeys(self.ids.values(), -1)
        #: what a merge took: the arc v of the state of u, and when
        self.taken: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.table: dict[int, bool] = {}
        #: tokens that begin with the next few bytes of a word, where no more bytes matter
        self.near: dict[bytes, tuple[tuple[int, int], ...]] = {}
        for when, (u, v) in enumerate(vocabulary.merges):
            a, b, w = vocabulary.ids[u], vocabulary.ids[v], vocabulary.ids[u + v]
            if w in self.parts:
                raise ValueError("two merges make one token")
            # the start has the arc w only if the state of u still has the arc v at this time
            if a in self.born and b in self.born and u in self.ids and v in self.ids and self._arc(a, b, when):
                self.ids[u + v] = w
            self.taken.setdefault((a, b), when)
            self.parts[w] = (a, b)
            self.born[w] = when
        #: the tokens by their bytes: from a byte to what may follow, and the length and token that end there
        self.spelling: dict = {}
        for label, token in self.ids.items():
            node = self.spelling
            for byte in label[:-1]:
                node = node.setdefault(byte, ({}, None))[0]
            last = node.get(label[-1])
            node[label[-1]] = (last[0] if last else {}, (len(label), token))

    def _arc(self, state: int, token: int, when: int) -> bool:
        """Whether the state of ``state`` has the arc ``token`` before gadget number ``when``."""
        while True:
            if self.taken.get((state, token), when) < when:
                return False
            made, copied = self.born[token], self.born[state]
            if made < 0 and copied < 0:
                return True
            if made >= copied:  # the gadget of the token added it where its left part was, after taking away
                when, token = made + 1, self.parts[token][0]
            else:  # the state began as a copy of its right part's, before anything was taken away
                when, state = copied, self.parts[state][1]

    def _missing(self, state: int, token: int) -> bool:
        """Fill in one entry of the transition table."""
        if len(self.table) >= TABLE:
            self.table.clear()
        known = self.table[state << 32 | token] = self._arc(state, token, len(self.parts))
        return known

    def _walk(self, word: bytes, place: int) -> tuple[tuple[int, int], ...]:
        """The tokens that ``word`` has at ``place`` with their lengths, longest first."""
        found = []
        node = self.spelling
        seen = 0
        for byte in word[place:]:
            seen += 1
            step = node.get(byte)
            if step is None:
                break
            node, ends = step
            if ends is not None:
                found.append(ends)
        else:
            seen += 1  # the end of the word was seen, too
        ahead = tuple(reversed(found))
        if seen <= NEAR:
            if len(self.near) >= BEGINNINGS:
                self.near.clear()
            self.near[word[place : place + NEAR]] = ahead
        return ahead

    def encode(self, word: bytes) -> list[int]:
        """The tokens along the one path that spells ``word``: longest arcs first, dead ends left once for all."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        length, table, near = len(word), self.table.get, self.near.get
        path: list[int] = []
        waiting = []
        places = []
        dead: set[int] = set()
        place, state = 0, -1
        choices = iter(near(word[:NEAR]) or self._walk(word, 0))
        while True:
            for size, token in choices:
                if state >= 0:
                    open_ = table(state << 32 | token)
                    if open_ is None:
                        open_ = self._missing(state, token)
                    if not open_:
                        continue
                if place + size not in dead:
                    break
            else:
                if not path:
                    raise ValueError("the vocabulary can't spell this word")
                dead.add(place)
                path.pop()
                state = path[-1] if path else -1
                place, choices = places.pop(), waiting.pop()
                continue
            path.append(token)
            places.append(place)
            place += size
            if place == length:
                return path
            waiting.append(choices)
            state = token
            choices = iter(near(word[place : place + NEAR]) or self._walk(word, place))


class Tokenizer:
    """Splits texts, runs the automaton on words it hasn't met lately, and puts ids together as 32-bit numbers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.automaton = MergeAutomaton(vocabulary)
        self.special = vocabulary.special
        self.labels = {i: b for b, i in vocabulary.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(names)})") if names else None
        new = f"[{ranges(NEWER)}]"
        letter, number = rf"(?:(?!{new})\p{{L}})", rf"(?:(?!{new})\p{{N}})"
        self.split = regex.compile(splitter(letter, number, rf"(?:{new}|[^{SPACE}\p{{L}}\p{{N}}])")).findall
        #: the same for texts of low code points only, with the classes spelled out, which the plain engine runs faster
        low = "".join(map(chr, range(LOW)))
        letters, numbers = (re.escape("".join(regex.findall(kind, low))) for kind in (r"\p{L}", r"\p{N}"))
        self.split_low = re.compile(splitter(f"[{letters}]", f"[{numbers}]", f"[^{SPACE}{letters}{numbers}]")).findall
        self.beyond = re.compile(f"[{chr(LOW)}-\U0010ffff]").search
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """What the automaton makes of a word, from the older half of the table if it is still there."""
        packed = self.older.get(word)
        if packed is None:
            packed = array("I", self.automaton.encode(word.encode())).tobytes()
        if len(word) <= 64:
            if len(self.words) >= WORDS:
                self.words, self.older = {}, self.words
            self.words[word] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        words = (self.split if self.beyond(text) else self.split_low)(text)
        known = list(map(self.words.get, words))
        if None in known:
            known = [k or self._word(w) for k, w in zip(known, words, strict=True)]
        return b"".join(known)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        pieces = self.cut.split(text)
        return b"".join(
            array("I", [self.special[p]]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(pieces)
        )

    def decode(self, packed: bytes) -> str:
        """The labels of the arcs in order, as text; bytes that aren't UTF-8 become U+FFFD."""
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


#: the tokenizers of this process by the id of their broadcast
_compiled: dict[str, Tokenizer] = {}


def tokenizer(name: str, vocabulary: Vocabulary) -> Tokenizer:
    """The compiled tokenizer of this worker; the automaton is built once a process."""
    if name not in _compiled:
        _compiled.clear()
        _compiled[name] = Tokenizer(vocabulary)
    return _compiled[name]


def encode_documents(
    docs: DataFrame, path: str, kept: Sequence[Column] | None = None, text: str = "text", decode: bool = True
) -> DataFrame:
    """``kept`` columns (all, if not given) with ``n_tokens``, ``ids`` and, if asked, ``decoded``.

    ``ids`` is binary, little-endian unsigned 32-bit numbers one after the other, as token files hold them.
    ``path`` names a tokenizer file that the driver reads; its merges, of
    a fixed size, are broadcast. Special strings in a text are their own token. NULL counts as an empty text,
    which has no tokens. Rows are neither moved nor dropped, and equal ones get equal ids. Without ``kept``,
    columns named like an added one are replaced.
    """
    vocabulary = load_vocabulary(path)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = f"{path}:{len(vocabulary.merges)}"

    def work(texts: list[str | None]) -> dict[str, list]:
        coder = tokenizer(name, held.value)
        packed = [coder.encode(t) for t in texts]
        found: dict[str, list] = {"n_tokens": [len(p) // 4 for p in packed], "ids": packed}
        if decode:
            found["decoded"] = [coder.decode(p) for p in packed]
        return found

    made = "n_tokens long, ids binary" + (", decoded string" if decode else "")
    others = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded")]
    return map_texts(docs, kept or [F.col(f"`{c}`") for c in others], text, work, made)


def decode_documents(
    tokens: DataFrame, path: str, kept: Sequence[Column], ids: str = "ids"
) -> DataFrame:
    """``kept`` columns with the ``decoded`` text of packed ids; NULL ids decode to an empty text."""
    vocabulary = load_vocabulary(path)
    held = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    name = f"{path}:{len(vocabulary.merges)}"

    def work(packed: Iterable[str | None]) -> dict[str, list]:
        coder = tokenizer(name, held.value)
        return {"decoded": [coder.decode(bytes.fromhex(p or "")) for p in packed]}

    return map_texts(tokens.withColumn("__hex", F.hex(F.col(f"`{ids}`"))), kept, "__hex", work, "decoded string")

