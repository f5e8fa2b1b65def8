"""Fill-in-the-middle: texts cut in three and put together with the middle last, and back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import tokens

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many stay plain, and of the others, how many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Code points that the pre-tokenizer is given at once; it keeps some hundred bytes for each.
SEGMENT = 256


class Ruler:
    """Code points of texts, as isolated matches of the Split pre-tokenizer.

    A text is measured piece by piece, between spaces, and each different piece
    of a batch is given to the pre-tokenizer once: the array of its offsets
    tells how many code points it has and where each begins.
    """

    def __init__(self):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex("(?m:.)"), "isolated")
        self.space = self.offsets(" ")

    def offsets(self, piece: str) -> np.ndarray:
        """Where each code point begins."""
        found: list[int] = []
        for at in range(0, len(piece), SEGMENT):
            found += [at + begin for _, (begin, _) in self.split.pre_tokenize_str(piece[at : at + SEGMENT])]
        return np.array(found, np.int64)

    def measure(self, texts: pa.Array) -> Measured:
        pieces = pc.split_pattern(texts, " ")
        found = pieces.flatten().dictionary_encode()
        offsets = [self.offsets(x) for x in found.dictionary.to_pylist()]
        which = found.indices.to_numpy(zero_copy_only=False)
        size = np.array([len(x) for x in offsets], np.int64)[which] + len(self.space)
        return Measured(offsets, which, np.concatenate([[0], np.cumsum(size)]), np.asarray(pieces.offsets) - pieces.offsets[0].as_py(), len(self.space))


class Measured:
    """Texts as pieces, each with the space behind it; ``ends`` are running sums of code points."""

    def __init__(self, offsets: list[np.ndarray], which: np.ndarray, ends: np.ndarray, first: np.ndarray, space: int):
        self.offsets, self.which, self.ends, self.first, self.space = offsets, which, ends, first, space
        # nothing stands behind a text's last piece
        self.n = ends[first[1:]] - ends[first[:-1]] - space

    def offset(self, text: int, rank: int) -> int:
        """Where the code point of that rank begins, or the text ends."""
        lo, hi = int(self.first[text]), int(self.first[text + 1])
        begin = int(self.ends[lo])
        piece = lo + int(np.searchsorted(self.ends[lo : hi + 1], begin + rank, side="right")) - 1
        piece = min(piece, hi - 1)
        within = begin + rank - int(self.ends[piece])
        own = self.offsets[self.which[piece]]
        return int(self.ends[piece]) - begin + (int(own[within]) if within < len(own) else within)


def _draws(salt: str, key) -> list[int]:
    digest = hashlib.sha256(f"{salt}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def _cut(salt: str, plain: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ruler = Ruler()
        for batch in batches:
            _, off = tokens.buffers(batch.column(1))
            for lo, hi in tokens.chunks(off):
                ids, column = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, *_forms(ruler, ids.to_pylist(), column, salt, plain, suffix_first)], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def _forms(ruler: Ruler, ids: list, column: pa.Array, salt: str, plain: int, suffix_first: int) -> list[pa.Array]:
    measured = ruler.measure(column)
    form, prefix_chars, middle_chars, output = [], [], [], []
    for k, (key, text) in enumerate(zip(ids, column.to_pylist(), strict=True)):
        n = int(measured.n[k])
        h1, h2, h3, h4 = _draws(salt, key)
        if not n or h3 % 100 >= 100 - plain or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            form.append("plain")
            prefix_chars.append(None)
            middle_chars.append(None)
            output.append(text)
            continue
        a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
        a_at, z_at = measured.offset(k, a), measured.offset(k, z)
        prefix, middle, suffix = text[:a_at], text[a_at:z_at], text[z_at:]
        if h4 % 100 < suffix_first:
            form.append("spm")
            output.append(f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
        else:
            form.append("psm")
            output.append(f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")
        prefix_chars.append(a)
        middle_chars.append(z - a)
    return [pa.array(measured.n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64()), pa.array(output, pa.string())]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Each row's id, n, form, prefix_chars, middle_chars and output.

    n counts code points.  Where a text is cut, and its form, depend on its id
    alone, by the SHA-256 of ``salt``, a colon and the id; a null id counts as
    no digits.  ``psm`` puts the prefix first and ``spm`` the suffix, each
    behind its mark, the middle last.  A text that is null (which counts as
    empty), is empty or holds a mark stays ``plain``, as do ``plain`` of a
    hundred others; its counts of prefix and middle are null.  Rows are taken by
    themselves, also if they are repeated; other columns are not read; an empty
    table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = source.mapInArrow(_cut(salt, plain, suffix_first), "id long, n long, form string, prefix_chars long, middle_chars long, output string")
    return cut.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` made the output of, by the output and its form alone.

    No mark can arise where a text and a mark meet, so each stands once.
    """
    parts = F.split(output, "<[PSM]>", 4)
    one, two, three = (F.get(parts, k) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
