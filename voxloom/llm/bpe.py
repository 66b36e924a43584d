"""BPE encoding and decoding with a deterministic automaton over tokens.

The merges are compiled one after another.  The automaton starts with one state that every byte leads
back to.  The gadget of a merge ``a b -> ab`` acts on it like this: all arcs ``a`` lead to a state s;
they are redirected to a copy of s without the arc ``b``, and wherever an arc ``a`` leaves, an arc ``ab``
is added that leads where ``b`` led from s.  What remains are exactly the token sequences that the merges
produce, so a word has one path, whose labels are its tokens.  A copy differs from its state in one arc
only, so states are kept as (copied from, arc removed, merge at which it was made).

A word is read byte by byte.  The token automaton is made deterministic over bytes by subset construction:
a state is the set of unfinished arcs, each a prefix of some label and the token state it leaves.  Every prefix of
a word has one path, so exactly one arc ends at each byte; a transition is (state, byte) -> (state, token
that ends here).  Transitions enter the table when they are first met; the table is bounded and started anew
when full.  The tokens are read off from the last byte back.  Work grows with the length of the word.

Words are cut by the vocabulary's pattern; which characters are letters, numbers and white space is asked of the
tokenizers library, once for each character met, as its Unicode tables differ from Python's.  Decoding emits the
labels of the arcs.

Nulls: a null text is empty and has no ids; ids of documents are passed through; repeated rows give
repeated results; texts and words of any length are read whole; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import Kept, ids_and_texts, per_text
from voxloom.llm.wordbpe import byte_letters

#: Arcs kept by state and token, and states of the byte table.
KEPT = 250_000
STATES = 100_000


class Automaton:
    """States and arcs of the token automaton; bytes are tokens of one byte."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.number = {bytes([b]): b for b in range(256)}  # label -> token, in order of making
        self.left, self.made = [0] * 256, [0] * 256  # first half of a token, merge that made it
        self.leads = [0] * 256  # state behind the arcs of a token
        self.copied, self.removed, self.born = [0], [-1], [0]
        for rank, (a, b) in enumerate(merges, 1):
            self._gadget(rank, a, b)
        labels = sorted(self.number, key=self.number.__getitem__)
        self.label = labels
        self.outside = [ids[x] for x in labels]
        self.known: dict[tuple[int, int], bool] = {}
        self.children: dict[int, int] = {}  # node of the labels' trie and byte -> node
        self.ends: list[int] = [-1]  # node -> token whose label it spells
        for token, label in enumerate(labels):
            node = 0
            for b in label:
                key = node << 8 | b
                node = self.children.get(key) or self.children.setdefault(key, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = token
        self._fresh_table()

    def _fresh_table(self) -> None:
        self.rows: dict[tuple[int, ...], dict] = {}
        self.start = self._row((0, 0))

    def _row(self, state: tuple[int, ...]) -> dict:
        """The table row of a byte state, given as node, token state, node, token state, ...; -1 holds the state."""
        row = self.rows.get(state)
        if row is None:
            row = self.rows[state] = {-1: state}
        return row

    def _transition(self, row: dict, byte: int) -> tuple[dict, int]:
        """Extend every unfinished arc by ``byte``; the one that ends in a label its state allows is the token here."""
        state, children, ends = row[-1], self.children, self.ends
        token, after = -1, []
        for i in range(0, len(state), 2):
            node = children.get(state[i] << 8 | byte)
            if node is not None:
                after += (node, state[i + 1])
                if token < 0 and ends[node] >= 0 and self.arc(state[i + 1], ends[node]):
                    token = ends[node]
        if len(self.rows) >= STATES:
            self._fresh_table()  # rows in use live on until the word ends
        found = row[byte] = (self._row((*after, 0, self.leads[token])), token)
        return found

    def _gadget(self, rank: int, a: bytes, b: bytes) -> None:
        u, v = self.number.get(a), self.number.get(b)
        if u is None or v is None:
            return  # a half that no path has
        s = self.leads[u]
        token = self.number.get(a + b)
        if not self._arc(s, v):
            return  # no path has these two in a row
        if token is None:
            token = self.number[a + b] = len(self.left)
            self.left.append(u)
            self.made.append(rank)
            self.leads.append(self.leads[v])
        self.copied.append(s)
        self.removed.append(v)
        self.born.append(rank)
        self.leads[u] = len(self.copied) - 1

    def _arc(self, state: int, token: int) -> bool:
        """Whether ``token`` leaves ``state``: an arc made after the state follows its first half's arc,
        an older one was copied unless removed."""
        left, made, born, removed, copied = self.left, self.made, self.born, self.removed, self.copied
        while state:
            b = born[state]
            while made[token] >= b:
                token = left[token]
            if token == removed[state]:
                return False
            state = copied[state]
        return True

    def arc(self, state: int, token: int) -> bool:
        key = (state, token)
        found = self.known.get(key)
        if found is None:
            if len(self.known) > KEPT:
                self.known.clear()
            found = self.known[key] = self._arc(state, token)
        return found

    def path(self, word: bytes) -> list[int]:
        """The tokens of the word's one path: a table step for each byte, then back from the last byte."""
        row, last = self.start, []
        for byte in word:
            found = row.get(byte)
            if found is None:
                found = self._transition(row, byte)
            row, token = found
            last.append(token)
        at, tokens = len(word), []
        while at:
            token = last[at - 1]
            tokens.append(self.outside[token])
            at -= len(self.label[token])
        tokens.reverse()
        return tokens


class Classes(dict):
    """``code point -> stand-in`` of the same class by the library's pre-tokenizer, for ``str.translate``.

    Printable ASCII stands for itself; other letters become ``\xc0``, numbers ``0``, white space a tab, the rest ``!``.
    """

    def __init__(self):
        super().__init__({c: c for c in range(0x20, 0x7f)})
        from tokenizers.pre_tokenizers import ByteLevel

        self.pieces = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def __missing__(self, code: int) -> str:
        c = chr(code)
        # Beside a letter, number or sign, a character of the same class stays in its piece.
        found = next((stand for lead, stand in (("a", "\xc0"), ("1", "0"), ("!", "!")) if len(self.pieces(lead + c)) == 1), "\t")
        self[code] = found
        return found


class Codec(Kept):
    """Words to their ids, as decimals joined by commas; built from a byte-level BPE vocabulary file."""

    def __init__(self, path: str | None = None):
        super().__init__()
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        vocab = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in back for c in t)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = Automaton([(bytes(back[c] for c in a), bytes(back[c] for c in b)) for a, b in merges], vocab)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.classes = Classes()
        latin = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
        # Texts of these characters need no stand-ins.
        self.plain = re.compile(f"[\\x20-\\x7e\\t\n\r{latin[6:]}]*")
        # The vocabulary's pattern (fixed value), over stand-ins.
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{latin}]+| ?[0-9]+| ?[^\\s0-9{latin}]+|\\s+(?!\\S)|\\s+")
        self.arcs = {str(i): t for t, i in vocab.items()} | {str(i): t.encode() for t, i in special.items()}

    def make(self, word: str) -> str:
        return ",".join(map(str, self.automaton.path(word.encode())))

    def _words(self, text: str) -> list[str]:
        if self.plain.fullmatch(text):
            return self.words.findall(text)
        return [text[slice(*m.span())] for m in self.words.finditer(text.translate(self.classes))]

    def encode(self, text: str) -> list[str]:
        """Ids as decimals; the strings of special tokens are these tokens."""
        parts, at = [], 0
        for m in self.cut.finditer(text) if self.cut else ():
            parts += [*map(self.__getitem__, self._words(text[at:m.start()])), str(self.special[m[0]])]
            at = m.end()
        parts += map(self.__getitem__, self._words(text[at:] if at else text))
        return ",".join(parts).split(",") if parts else []

    def decode(self, ids: list[str]) -> str:
        """The labels in turn; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.arcs.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(path: str | None = None) -> Codec:
    """Compiled once in a Python worker, which runs many tasks; the words it keeps are bounded."""
    return Codec(path)


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the round trip in digests."""

    def row():
        codec = codec_of(path)

        def one(text: str):
            ids = codec.encode(text)
            return (len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        return one

    made = per_text(row, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return ids_and_texts(docs, id_col, text_col).select("doc_id", made(F.col("text")).alias("s")).select("doc_id", "s.*")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``."""
    made = per_text(lambda: (lambda codec: lambda t: (list(map(int, codec.encode(t))),))(codec_of(path)), "ids array<int>")
    return ids_and_texts(docs, id_col, text_col).select("doc_id", made(F.col("text"))["ids"].alias("ids"))
