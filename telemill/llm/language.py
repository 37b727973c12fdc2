"""Language identification by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import map_slices

#: Bounds of the fit: documents of each language that are looked at, and bytes of them in its dictionary.
SAMPLE_DOCS, DICTIONARY_BYTES = 256, 16 << 10

#: Learned languages. More than that is an error: dictionaries go to every task.
MOST_LANGUAGES = 256

#: Texts are compressed in pieces, so that the dictionary counts as much at their end as at their start.
PIECE_BYTES = 4096

#: A text is rejected if the second best language needs less than this share more.
MARGIN = 0.004

#: Strong enough to find matches of three bytes all through the dictionary.
LEVEL = 12

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_LETTERS_ONLY = bytes(b if b >= 0x80 or chr(b).islower() else 0x20 for b in range(256))


def plain(text: str) -> bytes:
    """What is compressed: lower-case, with one blank for whatever lies between words of letters."""
    return b" ".join(text.lower().encode().translate(_LETTERS_ONLY).split())


def learn(docs: DataFrame, sample: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary for each `lang` of `docs`, at most `size` bytes from `sample` documents of it.

    The sample is the `sample` rows whose ids and texts hash lowest (repeated rows count once); each adds as much to the
    dictionary as the bound allows. Null texts and languages teach nothing; an empty frame gives no dictionary. Only hashes are
    ranked, pre-selected in every task, so no language's documents are gathered.
    """
    ranked = docs.where("lang is not null and text is not null and text <> ''").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("rank")
    )
    if docs.select("lang").distinct().limit(MOST_LANGUAGES + 2).count() > MOST_LANGUAGES + 1:  # one may be null
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    lowest = Window.partitionBy("lang").orderBy("rank")
    ranks = ranked.select("lang", "rank", F.row_number().over(lowest).alias("place"))
    ranks = ranks.where(F.col("place") <= sample).groupBy("lang", "rank").agg(F.min("place").alias("place"))
    # at most `sample` rows for each of MOST_LANGUAGES
    chosen = ranked.join(F.broadcast(ranks), ["lang", "rank"]).groupBy("lang", "place").agg(F.min("text").alias("text"))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        texts = [plain(t) for t in group["text"]]
        kept, left = [], size
        for i, t in enumerate(sorted(texts, key=len)):  # short texts leave their share to longer ones
            kept.append(t[: left // (len(texts) - i)])
            left -= len(kept[-1])
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "content": [b" ".join(kept)]})

    made = chosen.groupBy("lang").applyInPandas(gather, "lang string, content binary").collect()
    return {r["lang"]: bytes(r["content"]) for r in sorted(made)}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    dict_data=content, level=level, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, text: bytes) -> np.ndarray:
        """Compressed bytes with the dictionary of each language; the whole text in pieces of even size."""
        count = max(1, -(-len(text) // PIECE_BYTES))
        ends = [len(text) * i // count for i in range(count + 1)]
        pieces = [text[a:b] for a, b in pairwise(ends)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors])

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(plain(text))
        order = np.argsort(sizes, kind="stable")
        margin = 1 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0
        return self.languages[order[0]], float(1 / (1 + np.exp(-50 * margin))), bool(margin < MARGIN)


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """`docs` with `lang_pred`, `score` (0 to 1, from the margin to the second best) and `rejected`.

    Only `text` is looked at. Null, empty and letterless texts are `und` with score 0, and rejected; so is every text
    without any dictionary. Ties go to the first language by code point and are rejected, as is everything with a
    narrow margin; such rows keep their best language. Other columns pass through, but for columns of these three
    names, which are replaced. Rows are independent; an empty frame gives an empty frame.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    # one classifier for each worker, built on first use
    built: dict[int, Classifier] = {}

    def run(piece: pa.RecordBatch) -> dict:
        classifier = built.get(0) or built.setdefault(0, Classifier(dictionaries))
        made = [classifier.classify(t) for t in piece.column("text").to_pylist()]
        lang, score, rejected = map(list, zip(*made)) if made else ([], [], [])
        return dict(zip(piece.schema.names, piece.columns)) | {"lang_pred": lang, "score": score, "rejected": rejected}

    return map_slices(docs, "text", f"{schema}, lang_pred string, score double, rejected boolean", run)
