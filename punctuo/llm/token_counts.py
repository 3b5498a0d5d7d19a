"""Token counts (4): trie-shared dynamic programming over distinct pre-tokens.

A pre-token is a white-space word behind U+2581. Under a unigram model its best segmentation maximises the
sum of its pieces' scores (ties: fewer pieces). Distinct pre-tokens are inserted in a trie of characters;
a node holds the best forward score and piece count of its prefix, computed once when the node is made
from the nodes above it, so words with a common prefix share the work. The node a pre-token ends at gives
its count. Characters outside the vocabulary fall back to their UTF-8 bytes' pieces.

Each task has its own trie and no step shuffles; the trie starts anew beyond ``NODES`` nodes, which changes
no count. The vocabulary (checked size) is broadcast.

The public vocabularies carry merge ranks, not unigram scores, and tokenizers aren't trained here. So the
score of a piece is its log-probability under Zipf's law by its place in the vocabulary file; ``scores``
takes any other.

Defined cases: null, empty and blank texts have no pre-token and no token; repeated rows count one by one;
pre-tokens over ``LONG`` characters go through the same program without being kept in the trie; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import Known

SPACE = "▁"
NODES = 600_000
#: Bytes of the white-space words whose counts a worker remembers.
WORDS = 160_000_000
LONG = 200
#: Pieces of a vocabulary that is broadcast, at most (about 20 MB).
PIECES = 200_000


class Unigram:
    """Piece scores, and the score and number of byte pieces of a character without piece."""

    def __init__(self, pieces: dict[str, float], byte_scores: list[float]):
        self.pieces, self.byte_scores = pieces, byte_scores
        self.longest = max(map(len, pieces), default=1)
        by_end: dict[str, set[int]] = {}
        for p in pieces:
            by_end.setdefault(p[-2:], set()).add(len(p))
        #: By the last two characters (one, where the text has no more) the lengths of pieces that end so.
        self.lengths = {e: tuple(sorted(x | ({1} if e[-1] in pieces else set()), reverse=True)) for e, x in by_end.items()}

    def step(self, text: str, end: int, score: list[float], count: list[int]) -> tuple[float, int]:
        """Best (score, count) of ``text[:end]`` from those of all shorter prefixes."""
        best, n, get = -1e300, 0, self.pieces.get
        ending = text[end - 2:end] if end > 1 else text[:1]
        for k in self.lengths.get(ending) or ((1,) if text[end - 1] in self.pieces else ()):
            if k > end:
                continue
            own = get(text[end - k:end])
            if own is not None:
                got, many = score[end - k] + own, count[end - k] + 1
                if got > best or got == best and many < n:
                    best, n = got, many
        if text[end - 1] not in self.pieces:
            raw = text[end - 1].encode()
            got, many = score[end - 1] + sum(self.byte_scores[b] for b in raw), count[end - 1] + len(raw)
            if got > best or got == best and many < n:
                best, n = got, many
        return best, n

    def count(self, text: str) -> int:
        """Without sharing."""
        score, count = [0.0], [0]
        for end in range(1, len(text) + 1):
            s, n = self.step(text, end, score, count)
            score.append(s)
            count.append(n)
        return count[-1]


class SharedTrie:
    """Trie of pre-tokens; forward scores live in the nodes."""

    def __init__(self, model: Unigram, nodes: int = NODES):
        self.model, self.most = model, nodes
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # (node << 21 | character) -> node
        self.score, self.many = [0.0], [0]

    def terminal(self, text: str) -> int:
        """Inserts a pre-token; the piece count stored where it ends."""
        if len(text) > LONG:
            return self.model.count(text)
        if len(self.score) + len(text) > self.most:
            self._clear()
        node, child, score, many = 0, self.child, [0.0], [0]
        for end, sign in enumerate(text, 1):
            edge = node << 21 | ord(sign)
            below = child.get(edge)
            if below is None:
                s, n = self.model.step(text, end, score, many)
                below = child[edge] = len(self.score)
                self.score.append(s)
                self.many.append(n)
            node = below
            score.append(self.score[node])
            many.append(self.many[node])
        return self.many[node]


def zipf(n: int) -> np.ndarray:
    """Log-probabilities of places 0..n-1 under Zipf's law."""
    rank = np.arange(1, n + 1)
    return -np.log(rank) - np.log((1 / rank).sum())


def vocabulary(path: str, scores=zipf) -> tuple[dict[str, float], list[float]]:
    """Pieces of a SentencePiece model file with scores by place; control and unknown pieces are left out."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if len(sp) > PIECES:
        raise ValueError(f"{len(sp)} pieces; a vocabulary of over {PIECES} is not broadcast")
    by_place = scores(len(sp))
    pieces, of_byte = {}, [float(by_place[-1])] * 256
    for i in range(len(sp)):
        if sp.is_byte(i):
            of_byte[int(sp.id_to_piece(i)[3:5], 16)] = float(by_place[i])
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            pieces[sp.id_to_piece(i)] = float(by_place[i])
    return pieces, of_byte


def _counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # a worker keeps this dict, and so the trie, from task to task
        if "trie" not in held:
            held["trie"], held["words"] = SharedTrie(Unigram(*held["vocabulary"])), Known(WORDS)
        trie, known = held["trie"], held["words"]
        for b in batches:
            words_, tokens = [], []
            for x in b.column("text"):
                words = (x.as_py() or "").split()
                for w in sorted(known.missing(set(words))):
                    known[w] = trie.terminal(SPACE + w)
                words_.append(len(words))
                tokens.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words_, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["id", "n_pretokens", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", scores=zipf) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_pretokens, n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary(model_path, scores)})
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_counts(shared), f"id {kind}, n_pretokens long, n_tokens long")
            .withColumnRenamed("id", id_col))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
