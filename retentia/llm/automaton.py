"""BPE encoding and decoding by a tokenization automaton (operator 11).

The merges of a vocabulary are compiled into a deterministic automaton over its tokens whose
paths are exactly the token sequences that the merges produce. It begins as one state with an
arc for every letter. A merge (u, v) adds a gadget: the arcs u go to a copy of their
target that lacks the arc v, since u before v would have been merged, and every state with
an arc u gets an arc uv to where v led from there. Each arc of one label leads to the same
state, so a gadget copies one state, and a copy has its original's arcs less one. The automaton is
kept as these differences, a few numbers a merge; the whole table would have an arc for
most pairs of a state and a token.

A word has one path. Its letters are read once: from each place that the path of a beginning
of the word reaches, the labels that follow in the text are tried as arcs, and lead to the
states of longer beginnings. Transitions come from a table that fills as they are needed. Ids
decode by emitting the arcs' labels.

Words come from the definition's normaliser and pre-tokenizer (``word_split``). The vocabulary is
read on the driver (below 4 MB) and broadcast.

Defined results: null text is the empty text and has no ids; the added tokens' strings in a text are
those tokens, as the library has it; letters outside the vocabulary have no id and are left out; null
ids decode to null, unknown ids to nothing; repeated rows are encoded each; very long texts are read
whole, words without a blank too; an empty table gives no rows; an input column with the name of an
output column is replaced, all others are kept.

A definition whose model is not plain BPE, or two merges of which make the same token, is refused.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from retentia.llm.word_split import Splitter

START = 0
# Words and transitions that a worker keeps; once full, others are worked out anew.
CACHE_WORDS, CACHE_ARCS = 200_000, 1_000_000

_CACHE: dict = {}


class Automaton:
    """The token automaton of a merge list, in order of priority. ``vocabulary``: label -> id."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        made = {u + v for u, v in merges}
        letters = [(label, i) for label, i in vocabulary.items() if label not in made]
        self.spelled = {i: (label,) for label, i in letters}
        # a token's merge (0: a letter), the token on its left side, the state its arcs lead to, and the
        # state they led to at first
        self.born = dict.fromkeys(self.spelled, 0)
        self.left: dict[int, int] = {}
        self.target = dict.fromkeys(self.spelled, START)
        self.first = dict(self.target)
        # a state: the token whose arcs lead to it, and its merge
        self.owner, self.birth = [-1], [0]
        self.removed: dict[tuple[int, int], int] = {}  # (owner, token) -> merge of the copy without it
        self.arcs: dict[tuple[int, int], int] = {}
        for at, (u, v) in enumerate(merges, 1):
            self._gadget(at, *(vocabulary[x] for x in (u, v, u + v)))
        self.trie: dict = {}
        for token, letters in self.spelled.items():
            node = self.trie
            for letter in letters:
                node = node.setdefault(letter, {})
            node[""] = token

    def _gadget(self, at: int, u: int, v: int, uv: int) -> None:
        if uv in self.born:
            raise ValueError("two merges make the same token")
        if u not in self.born or v not in self.born or not self.has(self.target[u], v):
            return  # u is never followed by v: an earlier merge takes one of them
        self.born[uv], self.left[uv], self.spelled[uv] = at, u, self.spelled[u] + self.spelled[v]
        self.target[uv] = self.first[uv] = self.target[v]
        self.owner.append(u)
        self.birth.append(at)
        self.target[u] = len(self.owner) - 1
        self.removed[u, v] = at

    def has(self, state: int, token: int) -> bool:
        """Whether the state has an arc of the token: a letter's unless a forebear lost it, a merged token's if
        it had one of the left side when the token came, and no forebear since has lost it."""
        owner, time = self.owner[state], self.birth[state]
        while True:
            born = self.born[token]
            while owner >= 0:
                lost = self.removed.get((owner, token))
                if lost is not None and lost <= time:
                    return False
                if self.born[owner] <= born:
                    break
                state = self.first[owner]
                owner, time = self.owner[state], self.birth[state]
            if owner < 0 or not born:
                return True
            time, token = min(time, born), self.left[token]

    def step(self, state: int, token: int) -> int:
        """The state that the arc leads to, -1 without one."""
        key = (state, token)
        end = self.arcs.get(key)
        if end is None:
            end = self.target[token] if self.has(state, token) else -1
            if len(self.arcs) < CACHE_ARCS:
                self.arcs[key] = end
        return end

    def path(self, letters: list[str]) -> list[int]:
        """The tokens of the path that spells the letters."""
        n = len(letters)
        reached, back = [START] + [-1] * n, [(0, 0)] * (n + 1)
        for i in range(n):
            state, node = reached[i], self.trie
            for j in range(i, n):
                node = node.get(letters[j])
                if node is None:
                    break
                token = node.get("")
                if token is not None and reached[j + 1] < 0:
                    end = self.step(state, token)
                    if end >= 0:
                        reached[j + 1], back[j + 1] = end, (i, token)
        made = []
        while n:
            n, token = back[n]
            made.append(token)
        return made[::-1]


class _Words(dict):
    """Ids of the plain words seen first."""

    def __init__(self, coder) -> None:
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        made = self.coder.word(True, word)
        if len(word) <= 32 and len(self) < CACHE_WORDS:
            self[word] = made
        return made


class Coder:
    """Whole texts to ids and back, by the automaton of a definition."""

    def __init__(self, definition: str) -> None:
        rules = json.loads(definition)
        model = rules["model"]
        for name, plain in (("type", ("BPE",)), ("dropout", (None, 0.0)), ("byte_fallback", (None, False)),
                            ("ignore_merges", (None, False)), ("continuing_subword_prefix", (None, "")),
                            ("unk_token", (None,))):
            if model.get(name) not in plain:
                raise ValueError(f"the automaton has no form for {name} = {model.get(name)!r}")
        self.splitter = Splitter(definition)
        if not self.splitter.raw:
            raise ValueError("the automaton has no form for added tokens that are not matched as they stand")
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.letters = frozenset(label for s in self.automaton.spelled.values() for label in s)
        self.labels = {i: label for label, i in model["vocab"].items()}
        self.labels |= {i: label for label, i in self.splitter.added.items()}
        self.decoder = self.splitter.library.decoder
        self.words = _Words(self)

    def word(self, plain: bool, word: str) -> bytes:
        made = array("I")
        for piece in self.splitter.pieces(plain, word):
            letters = [x for x in [*piece[:-1], piece[-1] + self.suffix] if x in self.letters]
            made.extend(self.automaton.path(letters))
        return made.tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        plain = self.splitter.plain_words(text)
        if plain is not None:
            return b"".join(map(self.words.__getitem__, plain))
        made = []
        for added, part in self.splitter.parts(text):
            if added is not None:
                made.append(array("I", [added]).tobytes())
            else:
                made.extend([self.words[word] if plain else self.word(plain, word)
                             for plain, word in self.splitter.words(part)])
        return b"".join(made)

    def text(self, ids: bytes) -> str:
        """The labels that the ids emit, joined as the definition's decoder does, or by blanks."""
        labels = self.labels
        found = array("I", ids)
        try:
            emitted = [labels[i] for i in found]
        except KeyError:
            emitted = [labels[i] for i in found if i in labels]
        return self.decoder.decode(emitted) if self.decoder else " ".join(emitted)


def share_definition(spark: SparkSession, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _coder(definition: Broadcast) -> Coder:
    if _CACHE.get("definition") != definition.value:
        _CACHE.update(definition=definition.value, coder=Coder(definition.value))
    return _CACHE["coder"]


def _mapped(df: DataFrame, source: str, outputs: dict[str, T.DataType], make) -> DataFrame:
    """``df`` with columns computed from the column ``source``; ``make()`` gives the function."""
    keep = [i for i, c in enumerate(df.columns) if c not in outputs]
    at = df.columns.index(source)
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # any name, also with dots
    names = [f"c{i}" for i in keep] + [f"made{i}" for i in range(len(outputs))]
    kept = [T.StructField(f"c{i}", df.schema[i].dataType, True) for i in keep]
    schema = T.StructType([*kept, *[T.StructField(n, t, True) for n, t in zip(
        names[len(keep):], outputs.values(), strict=True)]])
    kinds = [pa.binary() if isinstance(t, T.BinaryType) else pa.string() for t in outputs.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for begin in range(0, batch.num_rows, 250):
                part = batch.slice(begin, 250)
                rows = [one(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in keep],
                     *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]], names=names)

    return numbered.mapInArrow(run, schema).toDF(*[df.columns[i] for i in keep], *outputs)


def encode(df: DataFrame, definition: Broadcast, text_col: str = "text", output_col: str = "token_ids",
           decoded_col: str | None = None) -> DataFrame:
    """Adds ``output_col``, each whole text's ids as little-endian unsigned 32-bit integers, and, if it
    is named, ``decoded_col``: the text that these ids decode to, in the same pass."""

    def make():
        coder = _coder(definition)

        def one(text):
            ids = coder.ids(text or "")
            return (ids, coder.text(ids)) if decoded_col else (ids,)

        return one

    outputs = {output_col: T.BinaryType()} | ({decoded_col: T.StringType()} if decoded_col else {})
    return _mapped(df, text_col, outputs, make)


def decode(df: DataFrame, definition: Broadcast, ids_col: str = "token_ids",
           output_col: str = "decoded") -> DataFrame:
    """Adds ``output_col``, the text that the ids decode to."""

    def make():
        coder = _coder(definition)
        return lambda ids: (None if ids is None else coder.text(ids),)

    return _mapped(df, ids_col, {output_col: T.StringType()}, make)
