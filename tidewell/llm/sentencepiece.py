"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

The segmentation of a text is the one with the highest sum of its pieces'
scores. Blanks mark word beginnings, and no piece of the vocabulary goes on
past a word's end, so the best segmentation of a text is that of its marked
words in a row. In each task the distinct marked words are sorted, which is
the depth-first order of their trie, and searched one after another: the
forward scores of a common prefix are kept, and only the characters below the
branch are searched anew. Words already met are remembered, within bounds, so
each text is then a look-up of its words. Nothing is shuffled.

Scores are those in the model file, whatever its kind: the operator searches
the best path over them, it does not replay merges. Among equal scores the
longer last piece wins. A character that is in no piece scores
``UNKNOWN`` less than the worst piece and becomes its UTF-8 byte pieces, so
every text decodes to itself.

Defined results: null text: null ids; empty text: no ids; white space and
literal word marks (U+2581) come back as they were. Repeated rows are encoded
each for itself. Extra columns are kept; input columns called like the output
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = 10.0
REMEMBERED = 200_000
CHUNK = 1_000_000
#: A blank or more with the word behind, a line break, or blanks at the end; no piece crosses these borders.
WORDS = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary:
    """Pieces with their scores, and the look-ups that the search needs."""

    def __init__(self, model: bytes):
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.suffixes: dict = {}  # pieces from their last character to their first; "" holds (score, id)
        worst = 0.0
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
                continue
            if m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.bytes_of.append(b"")
                continue
            text = piece.replace(MARK, " ")
            if re.search(r"[^ ] |\n", text):
                raise ValueError(f"piece {i} crosses a word border: {piece!r}")
            self.bytes_of.append(text.encode("utf-8"))
            worst = min(worst, m.get_score(i))
            node = self.suffixes
            for c in reversed(text):
                node = node.setdefault(c, {})
            node.setdefault("", (m.get_score(i), i))
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no pieces for single bytes")
        self.unknown = worst - UNKNOWN

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Sorted distinct words with their ids; forward scores of common prefixes are kept."""
        suffixes, unknown = self.suffixes, self.unknown
        score, came, last = [0.0], [0], [0]  # best score, begin and id of the last piece, by prefix length
        before = ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del score[shared + 1:], came[shared + 1:], last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                best, begin, piece = score[end - 1] + unknown, end - 1, -1
                node, i = suffixes, end
                while i:
                    node = node.get(word[i - 1])
                    if node is None:
                        break
                    i -= 1
                    own = node.get("")
                    if own is not None and score[i] + own[0] >= best:
                        best, begin, piece = score[i] + own[0], i, own[1]
                score.append(best)
                came.append(begin)
                last.append(piece)
            before = word
            parts, end = [], len(word)
            while end:
                begin, piece = came[end], last[end]
                if piece >= 0:
                    parts.append((piece,))
                else:
                    parts.append(tuple(self.byte_ids[b] for b in word[begin:end].encode("utf-8")))
                end = begin
            yield word, tuple(chain.from_iterable(reversed(parts)))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8")[1:]


class Encoder:
    """Encodes texts, remembering the words it has met."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.known: dict[str, tuple[int, ...]] = {}

    def _ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        return np.fromiter(chain.from_iterable(map(known.__getitem__, words)), dtype=np.int32)

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        self.known.update(self.vocabulary.encode_words(sorted(new)))

    def encode_all(self, texts) -> list[np.ndarray | None]:
        """Ids of every text; only so many characters are split into words at a time."""
        out: list[np.ndarray | None] = []
        group: list[list[str] | None] = []
        chars = 0

        def flush() -> None:
            self._learn(set().union(*[w for w in group if w]))
            out.extend(None if w is None else self._ids(w) for w in group)
            group.clear()

        for text in texts:
            if text is None:
                group.append(None)
            elif len(text) <= CHUNK:
                group.append(WORDS.findall(" " + text) if text else [])
                chars += len(text)
            else:
                flush()
                parts = []
                for piece in long_pieces(" " + text):
                    words = WORDS.findall(piece)
                    self._learn(set(words))
                    parts.append(self._ids(words))
                out.append(np.concatenate(parts))
            if chars > CHUNK:
                flush()
                chars = 0
        flush()
        return out


def long_pieces(text: str) -> Iterator[str]:
    """A long text in parts, cut only where a word begins."""
    a = 0
    while a < len(text):
        border = re.compile(r"(?<=[^ ]) ").search(text, a + CHUNK)
        b = border.start() if border else len(text)
        yield text[a:b]
        a = b


@lru_cache(maxsize=1)
def _encoder(model: bytes) -> Encoder:
    return Encoder(model)


def read_model(path: str = MODEL) -> bytes:
    """The model file's bytes, read once by the driver (vocabularies are small and of fixed size)."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "token_ids", model: bytes | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text."""
    data = model or read_model()

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoder(data).encode_all(texts), dtype=object)

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(docs: DataFrame, ids_col: str = "token_ids", out_col: str = "decoded", model: bytes | None = None) -> DataFrame:
    """``docs`` with the text of each row's ids (null ids: null)."""
    data = model or read_model()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        vocabulary = _encoder(data).vocabulary
        return pd.Series([None if x is None else vocabulary.decode(x.tolist()) for x in ids], dtype=object)

    return docs.withColumn(out_col, text(F.col(ids_col)))


def encode_checked(docs: DataFrame, text_col: str = "text", model: bytes | None = None) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``round_trip``: whether the ids decode to the text.

    Encoding and decoding share one pass, and the decoded text stays in its task.
    """
    data = model or read_model()
    plain, at = own_names(docs)
    kept = {c: n for c, n in at.items() if c not in ("token_ids", "n_tokens", "round_trip")}
    text, carried = at[text_col], list(kept.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data)
        for whole in batches:
            for batch in _by_chars(whole, text):  # small batches out: a task holds few ids at a time
                texts = batch.column(text).to_pylist()
                ids = encoder.encode_all(texts)
                same = [t is None if x is None else encoder.vocabulary.decode(x.tolist()) == t
                        for x, t in zip(ids, texts, strict=True)]
                counts = np.array([0 if x is None else len(x) for x in ids], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in carried], _as_lists(ids, counts), pa.array(counts), pa.array(same, pa.bool_())],
                    names=[*carried, "token_ids", "n_tokens", "round_trip"])

    fields = ", ".join([f"{n} {t}" for n, t in plain.dtypes if n in carried]
                       + ["token_ids array<int>", "n_tokens long", "round_trip boolean"])
    found = plain.mapInArrow(run, fields)
    return found.select(*[F.col(n).alias(c) for c, n in kept.items()], "token_ids", "n_tokens", "round_trip")


def _by_chars(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``CHUNK`` bytes of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // CHUNK
    cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def _as_lists(ids: list[np.ndarray | None], counts: np.ndarray) -> pa.ListArray:
    ends = np.cumsum(counts)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32),
                       mask=np.array([x is None for x in ids] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])))
