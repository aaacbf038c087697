"""Readings and simplified forms of Han characters, built by rule from the transliterator that Spark ships."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

FIRST, LAST = 0x4E00, 0x9FFF


@dataclass(frozen=True)
class Han:
    """simple: traditional to simplified characters; sound: character to its syllable without tone."""

    simple: dict[int, str]
    sound: dict[str, str]

    def simplified(self, text: str) -> str:
        return text.translate(self.simple)

    def syllables(self, text: str) -> str:
        return "".join(self.sound.get(c, c) for c in text)


def load(spark: SparkSession) -> Han:
    """The tables of the basic block, of one size whatever the data.

    Without them links by sound and between traditional and simplified forms would be missing from a result that
    looks whole, so a transliterator that is absent, fails or knows only part of the block is an error. Icu4j 77 reads
    all but 68 of the block's 20,992 characters and has simplified forms of 3,048.
    """
    chars = [chr(c) for c in range(FIRST, LAST + 1)]
    try:
        of = spark._jvm.com.ibm.icu.text.Transliterator.getInstance
        joined = "\n".join(chars)
        sounds = of("Han-Latin; Latin-ASCII; Lower").transliterate(joined).split("\n")
        simple = of("Hant-Hans").transliterate(joined).split("\n")
    except Exception as error:  # py4j raises what the missing class raises
        raise RuntimeError("readings of Han characters need the transliterator of Spark's icu4j, which is absent or failed") from error
    sound = {c: r for c, r in zip(chars, (s.strip() for s in sounds), strict=True) if r.isascii() and r.isalpha()}
    forms = {ord(c): r for c, r in zip(chars, simple, strict=True) if r != c}
    if len(sound) < 0.99 * len(chars) or len(forms) < 0.1 * len(chars):
        raise RuntimeError(f"the transliterator of icu4j gives no readings or no simplified forms of Han characters, or too few: {len(sound)} and {len(forms)} of {len(chars)}")
    return Han(forms, sound)
