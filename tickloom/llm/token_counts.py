"""Token counts of a byte-fallback BPE model of sentence pieces.

No piece of the vocabulary holds a blank after another character, so merges never cross such a border: a text is a
sequence of *pre-tokens*, blanks and what follows them. The same holds on both sides of a line feed that no piece
contains. Both are proved when the model is loaded, and so is which pieces, standing alone as a pre-token, come out as
one token: the whole-token shortcut. Pre-tokens among these count 1 at once, each other distinct one is merged once.

Defined results: a null text counts as empty; an empty text has no bytes and no tokens; rows are independent.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .arrow import map_texts, text_rows
from .chunks import RunCache

BLANK = "▁"


class PieceCounts:
    """Counts for the model at ``path``. Runs are pre-tokens without their single blank, or with several blanks."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        # What is proved offline: for this model, not for these texts.
        self.split_blank = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.split_line = not any("\n" in p for p in pieces)
        if self.model.normalize("ｆi  Á ") != f"{BLANK}ｆi{BLANK * 2}Á{BLANK}":
            raise ValueError(f"{path}: its normalizer changes texts, so pre-tokens can't be told")
        self.line = len(self.model.encode("a\n")) - len(self.model.encode("a"))
        words = [p[1:] for p in pieces if p[:1] == BLANK and BLANK not in p[1:] and len(p) > 1]
        self.whole = {w for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True) if len(ids) == 1}
        self.several = re.compile(" +[^ ]*")

    def runs(self, text: str) -> list[str]:
        """The pre-tokens; a single blank before one is left out."""
        if not text:
            return []
        text = text.replace(BLANK, " ")  # the model's own mark in a text is read as a blank
        if not self.split_blank:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [r[1:] if r[1:2] != " " else r for r in self.several.findall(" " + text)]

    def counts(self, runs: list[str]) -> list[int]:
        """Tokens of each distinct run."""
        whole = self.whole
        out = [1 if r in whole else 0 for r in runs]
        heads: list[str] = []  # as the model reads them: it puts the first blank itself
        tails: list[str] = []
        at: list[tuple[int, int, int]] = []
        for i, r in enumerate(runs):
            if out[i]:
                continue
            head, *lines = r.split("\n") if self.split_line else [r]
            out[i] = self.line * len(lines)
            if head in whole:
                out[i] += 1
                head = None
            elif head == "":  # a lone blank
                out[i] += 1
                head = None
            at.append((i, head is not None, sum(map(bool, lines))))
            if head is not None:
                heads.append(head[1:] if head[0] == " " else head)
            tails += [x for x in lines if x]
        # A tail has no blank before it: it is merged behind a line feed, which costs the lone blank and the feed.
        heads_n = iter(map(len, self.model.encode(heads, num_threads=1)))
        tails_n = iter([len(x) - 1 - self.line for x in self.model.encode(["\n" + t for t in tails], num_threads=1)])
        for i, one, more in at:
            out[i] += sum([next(heads_n) for _ in range(one)]) + sum([next(tails_n) for _ in range(more)])
        return out


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text."""

    def make():
        model = PieceCounts(model_path)
        known = RunCache(model.counts, kept=1_000_000)

        def work(_, texts):
            split = [model.runs(t) for t in texts]
            known.ready(set().union(*split))
            n = [sum(map(known.__getitem__, runs)) for runs in split]
            known.tidy()
            return [[len(t.encode()) for t in texts], n, [x > limit for x in n]]

        return work

    return map_texts(text_rows(docs, id_col, text_col), "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
