"""Licence notices by a positional index of rare words, in DataFrame functions alone.

A template is a notice: its words and the key phrases in it that must stand.  Licence
words are counted over all documents, and a template is indexed by two of its words: the
highest-IDF word of its first key phrase and the highest-IDF word among the others in its
key phrases, each with its position in the template.  A file looks up the indexed words
that it holds.  A posting moved back by its word's position in the template says where the
template would start; the starts of both words are intersected, and at each start left the
key phrases are compared word by word.

A template stands at word p when its first key phrase starts exactly there and every other
one starts at most SLACK words beside its place.  Both indexed words belong to key phrases,
so the lookup loses no such place, whatever the counts are.

The three base phrases are templates of their own with no slack.  ``score`` is the largest
share of a found template's words that stand at their exact places.

Everything is computed inside a text's own row: no join, no shuffle, nothing that grows
with the number of places.  Only the counts of the templates' words reach the driver.

Defined results: a null text is an empty one; texts are read whole; words are runs of
letters a-z (after lower-casing A-Z), digits and characters beyond ASCII; without a place
labels are empty strings, the score is 0 and first_word and last_word are null; repeated
rows are judged each time; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How far a key phrase after the first may stand beside its place in the template.
SLACK = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Opening words of public licence notices, as label and text; | marks the ends of key phrases.
NOTICES = (
    ("mit", "|permission is hereby granted free of charge| |to any person obtaining a copy| of this software and associated documentation files"),
    ("mit", "|released under the mit license|"),
    ("isc", "|permission to use copy modify and or distribute| this software for any purpose |with or without fee is hereby granted|"),
    ("bsd", "|redistribution and use in source and binary forms| |with or without modification| are permitted provided that"),
    ("apache-2.0", "|licensed under the apache license| |version 2 0|"),
    ("gpl-2.0", "|gnu general public license| |version 2|"),
    ("gpl-3.0", "|gnu general public license| |version 3|"),
    ("gpl-2.0", "|free software foundation| either |version 2 of the license|"),
    ("gpl-3.0", "|free software foundation| either |version 3 of the license|"),
    ("lgpl", "|gnu lesser general public license|"),
    ("agpl", "|gnu affero general public license|"),
    ("mpl-2.0", "|subject to the terms of the mozilla public license| |v 2 0|"),
    ("epl", "|eclipse public license|"),
    ("bsl-1.0", "|boost software license| |version 1 0|"),
    ("unlicense", "this is |free and unencumbered software| |released into the public domain|"),
    ("zlib", "|in no event will the authors be held liable| for |any damages arising from the use of this software|"),
    ("cc0-1.0", "|cc0 1 0 universal|"),
    ("cc-by-4.0", "|licensed under cc by 4 0|"),
    ("cc-by-sa-4.0", "|licensed under cc by sa 4 0|"),
    ("cc-by-nc-4.0", "|licensed under cc by nc 4 0|"),
    ("cc-by-4.0", "|creative commons attribution 4 0 international|"),
    ("cc-by-sa-4.0", "|creative commons attribution sharealike 4 0 international|"),
    ("cc-by-nc-4.0", "|creative commons attribution noncommercial 4 0 international|"),
)


@dataclass(frozen=True)
class Template:
    """A notice: its words, and the key phrases in it as (position, words); the first one leads."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]
    base: bool = False

    @property
    def slack(self) -> int:
        return SLACK if len(self.keys) > 1 else 0


def parse(label: str, marked: str, base: bool = False) -> Template:
    """A template from its text, in which bars enclose the key phrases."""
    words: list[str] = []
    keys = []
    for i, part in enumerate(marked.split("|")):
        own = tuple(part.split())
        if i % 2 and own:
            keys.append((len(words), own))
        words += own
    return Template(label, tuple(words), tuple(keys), base)


def templates() -> list[Template]:
    base = [parse(label, f"|{phrase}|", base=True) for phrase, label in BASE_PHRASES]
    return base + [parse(label, marked) for label, marked in NOTICES]


# ------------------------------------------------------------------------------------------ words
def words_of(text: Column) -> Column:
    """The words of a whole text."""
    plain = F.coalesce(text, F.lit(""))
    # lower() gives the same for ASCII texts, and faster
    lowered = F.when(F.octet_length(plain) == F.length(plain), F.lower(plain)).otherwise(F.translate(plain, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def document_counts(docs: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, int]:
    """In how many texts each word of the templates stands; a bounded number of rows."""
    own = F.array_intersect(words_of(docs[text]), F.array(*[F.lit(w) for w in vocabulary]))
    rows = docs.select(F.explode(own).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return {r["w"]: r["n"] for r in rows.collect()}


# ------------------------------------------------------------------------------------------ index
def rare_words(template: Template, counts: dict[str, int]) -> list[tuple[str, int]]:
    """The template's two indexed words and their positions: of the first key phrase, and of all other places.

    The fewer texts hold a word, the higher its IDF; words of no text come first.
    """
    places = [(w, t + i) for t, phrase in template.keys for i, w in enumerate(phrase)]
    lead = min(places[: len(template.keys[0][1])], key=lambda p: (counts.get(p[0], 0), p))
    others = [p for p in places if p != lead]
    return [lead, min(others, key=lambda p: (counts.get(p[0], 0), p))]


def _at(words: Column, place: Column, phrase: Sequence[str]) -> Column:
    """Whether the phrase's words stand one after another from ``place`` on; no place lies before the text."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.get(words, place + i) == F.lit(w), F.lit(False)) for i, w in enumerate(phrase)])


def _starts(hits: Column, word: str, position: int) -> Column:
    """The word's postings in the file, moved back to where the template would start."""
    return F.transform(F.filter(hits, lambda h: h["w"] == F.lit(word)), lambda h: h["i"] - F.lit(position))


def _around(starts: Column, slack: int) -> Column:
    if not slack:
        return starts
    return F.flatten(F.transform(starts, lambda s: F.sequence(s - F.lit(slack), s + F.lit(slack))))


def places_of(template: Template, counts: dict[str, int], words: Column, hits: Column) -> Column:
    """Where the template stands: the postings of its rare words intersected, then its key phrases compared."""
    (lead, lead_at), (other, other_at) = rare_words(template, counts)
    near = F.array_intersect(_starts(hits, lead, lead_at), _around(_starts(hits, other, other_at), template.slack))
    beside = F.sequence(F.lit(-template.slack), F.lit(template.slack))

    def beside_place(p: Column, at: int, phrase: Sequence[str]) -> Column:
        return F.exists(beside, lambda d: _at(words, p + at + d, phrase))

    def verified(p: Column) -> Column:
        (first_at, first), *rest = template.keys
        return reduce(lambda a, b: a & b, [_at(words, p + first_at, first), *[beside_place(p, at, phrase) for at, phrase in rest]])

    return F.filter(near, verified)


def _share(template: Template, words: Column, places: Column) -> Column:
    """The largest share of the template's words that stand at their exact places."""
    tokens = F.array(*[F.lit(w) for w in template.words])
    size = len(template.words)
    standing = F.transform(
        places,
        lambda p: F.size(F.filter(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.get(words, p + i) == F.get(tokens, i))),
    )
    return F.coalesce(F.array_max(standing), F.lit(0)) / F.lit(float(size))


def _joined(labels: Sequence[Column]) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))), ",")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known: Sequence[Template] | None = None) -> DataFrame:
    """One row for each document: its licence labels and where the base phrases stand."""
    known = templates() if known is None else list(known)
    counts = document_counts(docs, sorted({w for t in known for _, phrase in t.keys for w in phrase}), text)
    indexed = sorted({w for t in known for w, _ in rare_words(t, counts)})

    c = F.col
    with_words = docs.select(docs[key].alias("id"), words_of(docs[text]).alias("words"))
    # the words of a file that the index knows, with their positions; most files hold none
    numbered = F.transform(c("words"), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.when(
        F.arrays_overlap(c("words"), F.array(*[F.lit(w) for w in indexed])), F.filter(numbered, lambda h: h["w"].isin(indexed))
    ).otherwise(F.array().cast("array<struct<w:string,i:int>>"))
    looked_up = with_words.select("id", "words", hits.alias("hits"))
    found = looked_up.select(
        "id", "words", *[places_of(t, counts, c("words"), c("hits")).alias(f"p{k}") for k, t in enumerate(known)]
    )
    base = [k for k, t in enumerate(known) if t.base]
    starts = F.concat(*[c(f"p{k}") for k in base]) if base else F.array().cast("array<int>")
    label = [F.when(F.size(c(f"p{k}")) > 0, F.lit(t.label)) for k, t in enumerate(known)]
    shares = F.array(F.lit(0.0), *[_share(t, c("words"), c(f"p{k}")) for k, t in enumerate(known)])
    return found.select(
        c("id").alias(key),
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        _joined([label[k] for k in base] or [F.lit(None).cast("string")]).alias("base_labels"),
        _joined(label).alias("labels"),
        F.array_max(shares).alias("score"),
    )
