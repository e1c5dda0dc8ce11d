"""Language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 over fixed-length byte windows, max pooling and
softmax, trained in numpy on labelled texts. A document's windows cover all of
its text in batches; their mean logits give one softmax over the languages.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.convnet import ByteConvNet
from tillroll.llm.common import text_bytes
from tillroll.llm.textnet import apply_net, balanced, learn_sample, sample_windows

SIZE, STEP = 128, 124          # bytes of a window; the widest filter sees every place
WIDTHS = {2: 8, 3: 8, 4: 8}
STEPS = 120_000                # windows a training shows at least, small samples again and again
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


class LanguageModel:
    def __init__(self, net: ByteConvNet | None, languages: list[str]):
        self.net, self.languages = net, languages


def fit(docs: DataFrame, usable, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 1500, per_text: int = 8) -> LanguageModel:
    """Learn from the rows where the condition ``usable`` holds and text and language are there.

    The sample's bound: at most ``per_language`` texts of each language, at most 16 * per_language in all, and
    ``per_text`` windows of each text, drawn by a hash of key and text from all rows. Of more than
    ``textnet.MOST_LABELS`` languages the most frequent are learned.
    """
    rows = docs.where(usable & F.col(lang).isNotNull() & (F.length(text) > 0)) \
        .select(F.col(key).alias("id"), F.col(lang).alias("label"), text_bytes(F.col(text)).alias("body"))
    taken = learn_sample(rows, per_language, ["id", "body"])
    x, y = sample_windows(taken, SIZE, STEP, per_text, lower=True)
    names = sorted(set(y))
    if not names:
        return LanguageModel(None, [])
    y = np.array([names.index(v) for v in y])
    return LanguageModel(ByteConvNet(WIDTHS, len(names)).fit(
        x, y, balanced(y), epochs=max(8, -(-STEPS // len(x)))), names)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` (the softmax value of the predicted language).

    A null or empty text, or one without any letter, is ``und`` with score 0; so
    is everything if the model saw no labelled text.
    """
    if model.net is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = model.languages

    def finish(texts: list[bytes], z: np.ndarray) -> dict:
        letters = np.array([LETTER.search(t.decode("utf-8", "replace")) is not None for t in texts], bool)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return {"lang_pred": [names[b] if ok else UNKNOWN for b, ok in zip(best, letters)],
                "score": np.where(letters, p[np.arange(len(p)), best], 0.0)}

    return apply_net(docs, model.net, finish, "lang_pred string, score double", SIZE, STEP, True, text, keep)


def remainder(key: str, n: int):
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             folds: int = 4, held_out: int = 2, keep: list[str] | None = None) -> DataFrame:
    """Per row: key, held_out, lang_pred, score; the model learns from the other folds only.

    Key, language and source are never seen by a prediction. Null keys belong to
    the fold of empty text; repeated rows are scored alike; an empty table gives none.
    """
    fold = remainder(key, folds)
    model = fit(docs, fold != held_out, key, text, lang)
    out = predict(docs, model, keep or [key], text)
    return out.select("*", (remainder(key, folds) == held_out).alias("held_out"))


def recognised(docs: DataFrame, odds: float = 1.3, key: str = "doc_id", text: str = "text", lang: str = "lang",
               folds: int = 4, held_out: int = 2) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns.

    A text goes if it has no letter, or if the predicted language is not ``odds`` times as likely as the other
    languages are on average, ``score * (n - 1) < odds * (1 - score)``: a measure that means the same however
    many languages were learned. With one language any text with a letter stays, and so it does if nothing was labelled,
    since there is nothing to judge by.
    """
    model = fit(docs, remainder(key, folds) != held_out, key, text, lang)
    if model.net is None:
        return docs.where(F.col(f"`{text}`").rlike(r"\p{L}"))
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    out = predict(rows, model, ["text", "row"], "text")
    clear = F.col("score") * (len(model.languages) - 1) >= odds * (1 - F.col("score"))
    return out.where((F.col("lang_pred") != UNKNOWN) & clear).select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
