"""Token counts under a unigram vocabulary by dynamic programming over a trie of pre-tokens.

A pre-token is a run without ASCII white space behind a word mark. The best segmentation of a
pre-token's prefix does not depend on what follows, so its forward score belongs to a trie
node. A shard's distinct new pre-tokens, in order, are the trie's terminals depth first: the
path to a terminal keeps the nodes it shares with the path before and scores the others
once. Terminals store their number of tokens; a document sums those of its pre-tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_tasks, pieces, table

MARK = "▁".encode()
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Pieces of a SentencePiece file and their log chance.

    A merge vocabulary's scores are ranks, not chances; by Zipf's law a piece of rank r has
    the log chance -ln(r + 1), up to a constant. Special and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return {model.id_to_piece(k).encode(): -math.log(rank + 2) for rank, k in enumerate(plain)}


class Segmenter:
    """Counts tokens of pre-tokens: the segmentation of highest score, then of fewest tokens.

    A byte that no piece covers is a token of its own with the score `byte`.
    """

    def __init__(self, scores: dict[bytes, float], byte: float = -20.0):
        self.byte = byte
        self.endings: dict[bytes, float | None] = {}
        for piece in scores:
            for k in range(len(piece)):
                self.endings.setdefault(piece[k:], None)  # something that a piece ends with
        self.endings |= scores

    def counts(self, words: list[bytes]) -> dict[bytes, int]:
        """Tokens of each of the words, which are distinct and in order."""
        endings, byte, none = self.endings, self.byte, 1.0
        get = endings.get
        score, tokens = [0.0], [0]
        before, out = b"", {}
        for word in words:
            full = MARK + word
            shared, most = 0, min(len(before), len(full))
            while shared < most and before[shared] == full[shared]:
                shared += 1
            del score[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(full) + 1):
                best, count = score[end - 1] + byte, tokens[end - 1] + 1
                for start in range(end - 1, -1, -1):
                    own = get(full[start:end], none)
                    if own is None:
                        continue
                    if own > 0:
                        break
                    total, n = score[start] + own, tokens[start] + 1
                    if total > best or (total == best and n < count):
                        best, count = total, n
                score.append(best)
                tokens.append(count)
            out[word] = tokens[-1]
            before = full
        return out


def count_tokens(docs: DataFrame, scores: dict[bytes, float], shard_bytes: int = 2 << 20, most_known: int = 300_000) -> DataFrame:
    """(doc_id, n_bytes, n_pretokens, n_tokens) of every row's whole text; no shuffle.

    A null or empty text has none. A task remembers the counts of `most_known` pre-tokens and
    then begins anew, so its memory is bounded and no count is lost.
    """
    # plain data, which executors can read without this package
    whole = Segmenter(scores)
    sent = docs.sparkSession.sparkContext.broadcast((whole.endings, whole.byte))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter, known = Segmenter({}), {}
        segmenter.endings, segmenter.byte = sent.value
        for piece in pieces(batches, "text", shard_bytes):
            texts = [text or b"" for text in piece.column("text").cast(pa.binary()).to_pylist()]
            split = [text.split() for text in texts]
            distinct = set().union(*split)
            new = distinct.difference(known)
            if len(known) + len(new) > most_known:
                known, new = {}, distinct
            known |= segmenter.counts(sorted(new))
            total = [sum(map(known.__getitem__, words)) for words in split]
            columns = [piece.column("doc_id"), *(pa.array(np.array(x, np.int64)) for x in ([len(t) for t in texts], [len(w) for w in split], total))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_pretokens", "n_tokens"])

    schema = "doc_id long, n_bytes long, n_pretokens long, n_tokens long"
    return in_tasks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), task, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary())
