"""Token counts under a unigram vocabulary, by dynamic programming on a trie of pre-tokens.

Every word, with the word mark before it, is a pre-token.  A task inserts the distinct pre-tokens of
a run of texts in a trie.  A node is a prefix and holds its forward score: the best sum of piece
scores over all ways to cut it; it is computed once, from nodes above it, for all pre-tokens that
share the prefix.  The token count of a pre-token is stored where it ends and kept, within a bound,
for the texts to come.  No shuffle.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, slices

MARK = "▁"
_LOADED: dict = {}


def zipf_scores(model_file: str) -> dict[str, float]:
    """Pieces of a vocabulary file with log-probabilities by their rank (p ~ 1 / rank).

    The file orders pieces by merges and has no probabilities of its own; nothing is trained.
    Control and byte pieces are left out.
    """
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [own.id_to_piece(i) for i in range(own.get_piece_size()) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i))]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}


class Trie:
    """Token counts of words, by forward scores along the trie of the words at hand.

    Words are inserted in order, so the trie is walked depth first and only the path to the last word
    is held: per prefix its forward score, its tokens and the pieces that may still end below it.
    The next word goes on from the prefix it shares.  A character without a piece costs one token per
    UTF-8 byte.  Finished counts lie in two generations of about ``most_nodes`` terminals each: a word
    in use moves to the younger one, and the older is dropped when the younger is full.
    """

    def __init__(self, scores: dict[str, float], most_nodes: int = 400_000):
        self.most = most_nodes
        self.byte = min(scores.values(), default=0.0) - 5.0
        self.step: list[dict[str, int]] = [{}]  # the trie of the pieces: characters to the next state
        self.ends: list[float | None] = [None]
        for piece, score in scores.items():
            at = 0
            for char in piece:
                if char not in self.step[at]:
                    self.step[at][char] = len(self.step)
                    self.step.append({})
                    self.ends.append(None)
                at = self.step[at][char]
            self.ends[at] = score
        self.n_tokens: dict[bytes, int] = {}
        self.log_prob: dict[bytes, float] = {}
        self.older: tuple[dict, dict] = ({}, {})

    def insert_all(self, words):
        """Counts of all ``words`` are known afterwards, at least until the next call."""
        if len(self.n_tokens) > self.most:
            self.older = (self.n_tokens, self.log_prob)
            self.n_tokens, self.log_prob = {}, {}
        new, (n_old, p_old) = [], self.older
        for w in set(words) - self.n_tokens.keys():
            if w in n_old:
                self.n_tokens[w], self.log_prob[w] = n_old[w], p_old[w]
            else:
                new.append(w)
        self._walk(sorted(new))

    def forget_long(self, words, most_bytes: int = 64):
        """Long words seldom come again; they are not held."""
        for w in words:
            if len(w) > most_bytes:
                self.n_tokens.pop(w, None)
                self.log_prob.pop(w, None)

    def _walk(self, words):
        step, ends, byte = self.step, self.ends, self.byte
        score, tokens, open_pieces, last = [0.0], [0], [[]], ""
        for word in words:
            text = MARK + word.decode("utf-8", "replace")
            depth, most = 0, min(len(text), len(last))
            while depth < most and text[depth] == last[depth]:
                depth += 1
            del score[depth + 1 :], tokens[depth + 1 :], open_pieces[depth + 1 :]
            for char in text[depth:]:
                n_bytes = 1 if char < "\x80" else len(char.encode("utf-8", "replace"))
                best, count, going = score[-1] + n_bytes * byte, tokens[-1] + n_bytes, []
                for start, at in [*open_pieces[-1], (len(score) - 1, 0)]:
                    at = step[at].get(char)
                    if at is None:
                        continue
                    going.append((start, at))
                    piece = ends[at]
                    if piece is not None:
                        s, n = score[start] + piece, tokens[start] + 1
                        if s > best or (s == best and n < count):
                            best, count = s, n
                score.append(best)
                tokens.append(count)
                open_pieces.append(going)
            self.n_tokens[word], self.log_prob[word], last = tokens[-1], score[-1], text


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, log_prob`` (natural log, best cut): one row per row.

    Null and empty texts have no pre-tokens, no tokens and log probability 0.  Repeated rows count
    each; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        if model_file not in _LOADED:
            _LOADED[model_file] = Trie(zipf_scores(model_file))
        trie = _LOADED[model_file]
        for rows in slices(batches):
            words = [t.split() for t in rows.column(1).to_pylist()]
            every = set().union(*words)
            trie.insert_all(every)
            n = [sum(map(trie.n_tokens.__getitem__, own)) for own in words]
            score = [math.fsum(map(trie.log_prob.__getitem__, own)) for own in words]
            cols = [rows.column(0), pa.array([len(own) for own in words], pa.int64()), pa.array(n, pa.int64()), pa.array(score, pa.float64())]
            trie.forget_long(every)
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_pretokens", "n_tokens", "log_prob"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, log_prob double")
