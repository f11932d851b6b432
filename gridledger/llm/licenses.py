"""Licence scan with a positional index of rare key words. DataFrame functions only.

Each template is a list of words, some of which are its key phrase. The corpus says how rare the key's words are
(documents that hold them, over all documents), and the rarest of each key are indexed with their positions. In a
file, the positions of an indexed word minus its place in the template are the offsets at which the template could
begin; offsets that all indexed words of a template agree on are its alignments. An alignment counts if the key
phrase stands at its place and enough of the template's words match around it. As the key must stand word for word,
no place that counts lacks an indexed word, however the other words are altered and however rare they are.

Everything but the counts of words happens inside a document's row: there is no shuffle of texts or words.

Defined cases: a null text is empty; a document without words or licences has no labels and the score 0; every
row, repeated ones too, gives one row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import clean_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that give a label wherever their words stand together; all end in the same word.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_LAST = "license"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    key: str


#: Opening sentences of common licences and notices, as words; key: what must stand there word for word.
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "licensed under the gnu general public license version 2", "general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def rare_words(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, per_template: int = 3) -> list[list[str]]:
    """The rarest words of each template's key over all documents. The counts are as many as the keys' words."""
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(clean_text()), _strings(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [sorted(set(t.key.split()), key=lambda w: (counts.get(w, 0), w))[:per_template] for t in templates]


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, per_template: int = 3, least_match: float = 0.6) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rare = rare_words(docs, templates, per_template)
    indexed = sorted({BASE_LAST, *(w for r in rare for w in r)})
    rows = docs.select("doc_id", words_of(clean_text()).alias("words"))
    # Occurrences of indexed words: the only ones that are looked at again.
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(indexed))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("places", F.when(F.arrays_overlap("words", _strings(indexed)), places).otherwise(_no_places()))
    rows = rows.withColumns({f"at_{k}": F.transform(F.filter("places", _is(w)), lambda x: x["i"]) for k, w in enumerate(indexed)})
    number = {w: k for k, w in enumerate(indexed)}

    def stands(start: Column, phrase: str) -> Column:
        """Whether the phrase's words stand at start (from 0)."""
        ok = start >= 0
        for i, w in enumerate(phrase.split()):
            ok = ok & F.coalesce(F.get("words", start + i) == w, F.lit(False))
        return ok

    base = {}
    for phrase, label in BASE.items():
        lead = len(phrase.split()) - 1
        starts = F.transform(F.col(f"at_{number[BASE_LAST]}"), _minus(lead))
        base[label] = F.filter(starts, _at(stands, 0, phrase))
    rows = rows.withColumns({f"base_{label}": c for label, c in base.items()})

    aligned = {}
    for k, (t, r) in enumerate(zip(templates, rare)):
        words, key = t.words.split(), t.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        offsets = [F.transform(F.col(f"at_{number[w]}"), _minus(at + key.index(w))) for w in r]
        verified = F.filter(reduce(F.array_intersect, offsets), _at(stands, at, t.key))
        matches = F.transform(verified, _matched(words))
        aligned[k] = F.coalesce(F.array_max(matches), F.lit(0.0))
    found_any = F.size("places") > 0
    rows = rows.withColumns({f"match_{k}": F.when(found_any, c).otherwise(F.lit(0.0)) for k, c in aligned.items()})

    starts = F.concat(*[F.col(f"base_{label}") for label in base])
    base_labels = [F.when(F.size(f"base_{label}") > 0, F.lit(label)) for label in base]
    own = [F.when(F.col(f"match_{k}") >= least_match, F.lit(t.label)) for k, t in enumerate(templates)]
    join = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))))
    best = F.greatest(*[F.when(F.col(f"match_{k}") >= least_match, F.col(f"match_{k}")).otherwise(F.lit(0.0)) for k in aligned])
    return rows.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        join(base_labels).alias("base_labels"),
        join([*base_labels, *own]).alias("labels"),
        # A base phrase alone is half a proof.
        F.when(F.size(starts) > 0, F.greatest(best, F.lit(0.5))).otherwise(best).alias("score"),
    )


def _is(word: str):
    return lambda x: x["w"] == word


def _minus(n: int):
    return lambda i: i - n


def _at(stands, shift: int, phrase: str):
    return lambda start: stands(start + shift, phrase)


def _matched(words: list[str]):
    """The share of a template's words that stand at their places for a given start."""

    def share(start: Column) -> Column:
        hits = [F.when(F.coalesce(F.get("words", F.when(start + i >= 0, start + i)) == w, F.lit(False)), 1).otherwise(0) for i, w in enumerate(words)]
        return sum(hits, F.lit(0)) / F.lit(len(words))

    return share


def _no_places() -> Column:
    return F.array().cast("array<struct<w:string,i:int>>")
