"""Token counts by trie-shared dynamic programming (operator 6).

The tokens of a word are those of its best segmentation under unigram scores of a public
vocabulary. The distinct words of a chunk are put in a trie; sorted order walks the trie
depth first, so the forward scores of a prefix are computed once for all words that share
it. The count at a word's end node is stored and summed over the texts.

Scores: the vocabulary file holds ranks, not probabilities, so a piece has the Zipf score
-log(rank + 3). A character outside the vocabulary costs one token for each of its UTF-8
bytes. Of equally good segmentations the one with fewer tokens counts.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, table

VOCABULARY = "piece_bpe_32k.model"
BYTE_SCORE = -20.0
#: Words remembered by a worker; a full memory is emptied, which changes no result.
REMEMBERED = 400_000
TEXT_BYTES = 8 << 20


def load(path: str) -> dict[str, float]:
    """Scores of the pieces of a vocabulary file, control and byte pieces left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rank, scores = 0, {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            scores[sp.id_to_piece(i)] = -math.log(rank + 3)
            rank += 1
    return scores


def trie_counts(words, scores: dict[str, float]) -> dict[str, int]:
    """Tokens of each distinct word, with forward scores shared along common prefixes."""
    longest = max(map(len, scores), default=1)
    get = scores.get
    out, before = {}, ""
    best, count = [0.0], [0]
    for word in sorted(words):
        shared = 0
        for a, b in zip(word, before, strict=False):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            top, n = best[end - 1] + BYTE_SCORE * size, count[end - 1] + size
            for begin in range(max(0, end - longest), end):
                s = get(word[begin:end])
                if s is not None:
                    s += best[begin]
                    if s > top or s == top and count[begin] + 1 < n:
                        top, n = s, count[begin] + 1
            best.append(top)
            count.append(n)
        out[word] = count[-1]
        before = word
    return out


def _counter(path: str):
    def run(batches):
        scores, known = load(path), {}
        for part in chunks(batches, limit=TEXT_BYTES):
            texts = [(t or "").encode("utf-8").split() for t in part.column(1).to_pylist()]
            new = set()
            for t in texts:
                new.update(t)
            if len(known) > REMEMBERED:
                known.clear()
            new = {"▁" + w.decode("utf-8"): w for w in new if w not in known}
            for w, n in trie_counts(new, scores).items():
                known[new[w]] = n
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([sum(map(known.__getitem__, t)) for t in texts], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_tokens of the whole text.

    Null, empty and wordless texts have 0 of both. Rows without a doc_id are left out;
    repeated rows give a row each. Other columns are not read.
    """
    return docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(_counter(path), "doc_id long, n_words long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
