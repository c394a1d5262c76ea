"""Token counts of whole texts for a SentencePiece BPE vocabulary.

Whole-token shortcut: which vocabulary strings encode alone as one token is
proved once per Python worker, by encoding each of them.  Texts are then cut at
borders that no merge can cross; pre-tokens in the proved set count one, and
only the rest are merged by the library.

A border is safe because no piece of the vocabulary has the word mark after
another character, and none holds a line feed beside other characters: a merge
across such a border would need a piece that does.  Both facts are read from
the model; where they fail, the whole text is encoded by the library.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Merged pre-tokens that a worker remembers; only time depends on it.
REMEMBERED = 300_000
_RUNS = re.compile(r" *[^ ]+| +")


class PieceCounter:
    """Counts tokens of texts as the library would, without begin or end marks."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto = pb.ModelProto()
        proto.ParseFromString(self.sp.serialized_model_proto())
        norm, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
        pieces = [p.piece for p in proto.pieces if p.type == kinds.NORMAL]
        self.safe = (
            norm.name == "identity"
            and norm.add_dummy_prefix
            and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces
            and not norm.precompiled_charsmap
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and all(p.type != kinds.USER_DEFINED for p in proto.pieces)
            and not any(re.search(f"[^{MARK}]{MARK}", p) or "\n" in p for p in pieces)
        )
        self.line_feed = len(self.sp.encode("\n")) - 1
        # proved offline: strings that stand alone as one token after a space / at a line start
        words = [p[1:] for p in pieces if p[0] == MARK and len(p) > 1 and MARK not in p[1:]]
        bare = [p for p in pieces if MARK not in p]
        self.after_space = {w: 1 for w, ids in zip(words, self.sp.encode(words), strict=True) if len(ids) == 1}
        self.at_start = {w: 1 for w, n in zip(bare, self._bare(bare), strict=True) if n == 1}
        self.whole_tokens = (len(self.after_space), len(self.at_start))

    def _bare(self, words: list[str]) -> list[int]:
        """Tokens of words without a mark before them: a line feed shields the mark."""
        return [len(ids) - 1 - self.line_feed for ids in self.sp.encode(["\n" + w for w in words])]

    def _rest(self, words: list[str], known: dict[str, int], merge) -> int:
        """Merge the pre-tokens that the proved set does not hold."""
        fresh = list(dict.fromkeys(words))
        sizes = dict(zip(fresh, merge(fresh), strict=True))
        if len(known) < REMEMBERED:
            known.update((w, n) for w, n in sizes.items() if len(w) <= 40)
        return sum(map(sizes.__getitem__, words))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.safe:
            return len(self.sp.encode(text))
        text = text.replace(MARK, " ")
        if "  " in text or "\n " in text or text[0] == " " or text[-1] == " " or " \n" in text:
            return self._count_spaced(text)
        lines = text.split("\n")
        words = lines[0].split(" ")
        starts = []
        for line in lines[1:]:
            first, *more = line.split(" ")
            if first:
                starts.append(first)
            words += more
        if not lines[0]:
            words = words[1:]  # the text opens with a line feed: the mark stands alone
        total = (len(lines) - 1) * self.line_feed + (not lines[0])
        total += self._all(words, self.after_space, lambda ws: map(len, self.sp.encode(ws)))
        return total + self._all(starts, self.at_start, self._bare)

    def _count_spaced(self, text: str) -> int:
        """Texts with runs of spaces: a run and what follows it are one pre-token."""
        lines = (" " + text).split("\n")
        total = (len(lines) - 1) * self.line_feed
        marked, bare = [], []
        for line in lines:
            for t in _RUNS.findall(line):
                if t[0] != " ":
                    bare.append(t)
                elif len(t) > 1:
                    marked.append(t[1:])
                else:
                    total += 1
        after, at = self.after_space, self.at_start
        total += self._all(marked, after, lambda ws: map(len, self.sp.encode(ws)))
        return total + self._all(bare, at, self._bare)

    def _all(self, words: list[str], known: dict[str, int], merge) -> int:
        """Proved words count by themselves, the rest is merged."""
        if rest := [w for w in words if w not in known]:
            total, left = self._rest(rest, known, merge), set(rest)
            return total + sum(known[w] for w in words if w not in left)
        return sum(map(known.__getitem__, words))


@functools.cache
def counter_of(model_path: str) -> PieceCounter:
    """The counter of a Python worker, made once for all its tasks."""
    return PieceCounter(model_path)


def _counted(model_path: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_path)
        for batch in batches:
            texts = batch.column(text_col)
            sizes = []
            for at in range(0, len(texts), 512):
                sizes += [counter.count(t or "") for t in texts.slice(at, 512).to_pylist()]
            keep = [i for i, n in enumerate(batch.schema.names) if n != text_col]
            names = [batch.schema.names[i] for i in keep] + ["n_tokens"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(sizes, pa.int64())], names=names)

    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit.

    NULL and empty texts have no bytes and no tokens; repeated rows and NULL ids
    are kept as they come; other columns are ignored.  No shuffle: each text is
    counted where it is read.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(src.dtypes)["_id"]
    out = src.mapInArrow(_counted(model_path, "_text"), f"_id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
