"""Token counts of a unigram model by dynamic programming over a trie of pre-tokens.

A pre-token is a word with its leading space mark. Each worker inserts the distinct
pre-tokens it meets into a trie. The best score of a prefix depends on the prefix alone,
so it is computed once per trie node and shared by all pre-tokens below; a terminal node
stores the token count of its pre-token. A document's count is the sum over its words.

The vocabulary is a public file given by path; its pieces are ordered by merge, and the
score of a piece is the log of a Zipf share of that order. Nothing is trained.
"""

import math
from collections import deque

from pyspark.sql import functions as F

from .rows import map_slices, texts_of

SPACE = "▁"
#: Trie nodes a worker keeps; beyond it the trie starts anew, which changes no count.
MOST_NODES = 1_500_000
#: Longer pre-tokens, as scripts without blanks have, share no prefix worth keeping. They go by the
#: same recurrence over a window of the longest piece, and leave no node.
LONG_WORD = 256


def piece_scores(path):
    """Piece -> score, and the score of one byte of a character without a piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    total = math.log(sum(1 / (rank + 2) for rank in range(len(plain))))
    scores = {piece: -math.log(rank + 2) - total for rank, piece in enumerate(plain)}
    return scores, min(scores.values()) - 10


class CountingTrie:
    """Nodes hold the best score and token count of their prefix; terminals the counts of words.

    A child is found by its parent's number and its character, packed into one key.
    """

    def __init__(self, scores, byte_score):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self):
        self.children, self.best, self.tokens, self.terminals = {}, [0.0], [0], {}

    def _extend(self, path, text, end):
        """Best segmentation of text[:end], whose shorter prefixes are the nodes of ``path``."""
        size = len(text[end - 1].encode("utf-8", "surrogatepass"))
        score = self.best[path[-1]] + size * self.byte_score
        tokens = self.tokens[path[-1]] + size
        get = self.scores.get
        for start in range(max(0, end - self.longest), end):
            own = get(text[start:end])
            if own is not None:
                node = path[start]
                reached, count = self.best[node] + own, self.tokens[node] + 1
                if reached > score or reached == score and count < tokens:
                    score, tokens = reached, count
        return score, tokens

    def _rolling(self, text):
        """Tokens of a text, holding only the prefixes that a piece can reach back to."""
        best, tokens, get = deque([0.0], self.longest), deque([0], self.longest), self.scores.get
        for end, ch in enumerate(text, 1):
            size = len(ch.encode("utf-8", "surrogatepass"))
            score, count = best[-1] + size * self.byte_score, tokens[-1] + size
            for back in range(min(self.longest, end), 0, -1):
                own = get(text[end - back : end])
                if own is not None:
                    reached, more = best[-back] + own, tokens[-back] + 1
                    if reached > score or reached == score and more < count:
                        score, count = reached, more
            best.append(score)
            tokens.append(count)
        return tokens[-1]

    def count(self, word):
        """Tokens of a word behind its space mark; inserted at its first use."""
        known = self.terminals.get(word)
        if known is not None:
            return known
        if len(word) > LONG_WORD:
            return self._rolling(SPACE + word)
        if len(self.best) > MOST_NODES:
            self.clear()
        node, path, text = 0, [0], SPACE + word
        for end, ch in enumerate(text, 1):
            key = node << 21 | ord(ch)
            following = self.children.get(key)
            if following is None:
                score, tokens = self._extend(path, text, end)
                following = self.children[key] = len(self.best)
                self.best.append(score)
                self.tokens.append(tokens)
            node = following
            path.append(node)
        self.terminals[word] = self.tokens[node]
        return self.tokens[node]

    def total(self, words):
        """Tokens of all words of a text; only new words are walked through the trie."""
        found = [*map(self.terminals.get, words)]
        if None in found:
            found = [self.count(w) if n is None else n for n, w in zip(found, words)]
        return sum(found)


_TRIES = {}


def counting_trie(path):
    """One trie per Python worker, which Spark uses for many tasks."""
    if path not in _TRIES:
        _TRIES[path] = CountingTrie(*piece_scores(path))
    return _TRIES[path]


def count_tokens(docs, model_path, id_col="doc_id", text_col="text"):
    """doc_id, n_pretokens and n_tokens of every row of ``docs``.

    Pre-tokens are parted by Unicode white space. Null and empty texts count 0, repeated
    rows repeat, ties between segmentations go to fewer tokens, other columns are not read.
    """

    def work(slices):
        trie = counting_trie(model_path)
        for batch in slices:
            ids, texts = texts_of(batch, 0, 1)
            words = [t.split() for t in texts]
            yield {"doc_id": ids, "n_pretokens": [*map(len, words)], "n_tokens": [*map(trie.total, words)]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs.select(F.col(id_col), F.col(text_col)), work, f"doc_id {kind}, n_pretokens long, n_tokens long")
