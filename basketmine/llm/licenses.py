"""License scans by ordered signature rules.

A few hundred regular expressions, built from the hand-written templates below, are
gated by keywords: one Aho-Corasick pass over a group of texts tells which rules can
match in which text, and only those run.  Overlapping detections are resolved by
interval containment: a detection inside another of at least its priority is
suppressed.  Beside them three base phrases are looked up word by word.

Texts are scanned where they lie (no shuffle).  Null or empty texts have no words and
no detections; repeated rows are each scanned; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, LOWER, joined_bytes, word_spans

SCAN_BYTES = 4_000_000
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
BASE_CONFIDENCE = 0.9
_GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"      # what separates two words
_OPEN, _CLOSE = r"(?<![0-9a-z\x80-\xff])", r"(?![0-9a-z\x80-\xff])"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str       # over lower-cased text; blanks stand for any run of separators
    keywords: tuple[str, ...]  # all of them must occur
    priority: int
    confidence: float


# License identifiers, names, versions and phrases of the rules.
SPDX = ["0bsd", "afl-3.0", "agpl-3.0", "apache-1.1", "apache-2.0", "artistic-2.0", "bsd-2-clause", "bsd-3-clause",
        "bsd-4-clause", "bsl-1.0", "cc0-1.0", "cddl-1.0", "cecill-2.1", "ecl-2.0", "epl-1.0", "epl-2.0", "eupl-1.2",
        "gfdl-1.3", "gpl-2.0", "gpl-3.0", "isc", "lgpl-2.1", "lgpl-3.0", "mit", "mpl-1.1", "mpl-2.0", "ms-pl", "ncsa",
        "odbl-1.0", "ofl-1.1", "osl-3.0", "postgresql", "python-2.0", "unlicense", "upl-1.0", "vim", "wtfpl", "zlib"]
GNU = {"gpl": "general public", "lgpl": "(?:lesser|library) general public", "agpl": "affero general public",
       "gfdl": "free documentation"}
GNU_VERSIONS = ["1", "1.1", "1.2", "1.3", "2", "2.1", "3"]
CC = {"by": "attribution", "by-sa": "attribution share[ -]?alike", "by-nd": "attribution no[ -]?derivatives",
      "by-nc": "attribution non[ -]?commercial", "by-nc-sa": "attribution non[ -]?commercial share[ -]?alike",
      "by-nc-nd": "attribution non[ -]?commercial no[ -]?derivatives"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
VERSIONED = {"apache": ("apache", ["1.0", "1.1", "2.0"]), "mpl": ("mozilla public", ["1.0", "1.1", "2.0"]),
             "epl": ("eclipse public", ["1.0", "2.0"]), "eupl": ("european union public", ["1.0", "1.1", "1.2"]),
             "cddl": ("common development and distribution", ["1.0", "1.1"]), "ofl": ("sil open font", ["1.0", "1.1"]),
             "osl": ("open software", ["1.0", "2.0", "2.1", "3.0"]), "afl": ("academic free", ["2.0", "2.1", "3.0"]),
             "artistic": ("artistic", ["1.0", "2.0"]), "bsl": ("boost software", ["1.0"]),
             "odbl": ("open database", ["1.0"]), "cpl": ("common public", ["1.0"])}
PHRASES = {
    "mit": ["mit license", "licensed under mit", "expat license",
            "permission is hereby granted free of charge to any person obtaining a copy"],
    "bsd-2-clause": ["2 clause bsd", "two clause bsd", "simplified bsd license", "freebsd license"],
    "bsd-3-clause": ["3 clause bsd", "three clause bsd", "new bsd license", "modified bsd license",
                     "neither the name of the copyright holder nor the names of its contributors"],
    "bsd-4-clause": ["4 clause bsd", "original bsd license", "all advertising materials mentioning features or use of this software"],
    "bsd": ["bsd license", "redistribution and use in source and binary forms"],
    "isc": ["isc license", "permission to use copy modify and or distribute this software for any purpose"],
    "zlib": ["zlib license", "altered source versions must be plainly marked as such"],
    "unlicense": ["the unlicense", "this is free and unencumbered software released into the public domain"],
    "wtfpl": ["do what the fuck you want to public license"],
    "cc0": ["cc0", "creative commons zero", "no rights reserved"],
    "public-domain": ["public domain", "dedicated to the public domain"],
    "apache": ["apache license", "apache software license"],
    "gpl": ["gnu general public license", "gnu gpl"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license", "gnu lgpl"],
    "agpl": ["gnu affero general public license", "gnu agpl"],
    "gfdl": ["gnu free documentation license"],
    "creative-commons": ["creative commons license", "creative commons attribution"],
    "proprietary": ["all rights reserved", "proprietary and confidential", "no part of this publication may be reproduced",
                    "may not be copied or distributed without", "unauthorized copying of this file"],
    "commercial": ["commercial license", "end user license agreement", "software license agreement"],
    "non-commercial": ["non commercial use only", "for noncommercial purposes", "research use only"],
    "copyleft": ["share alike license", "same license as the original"],
    "license-notice": ["licensed under the", "released under the terms of", "distributed under the license",
                       "see the license file", "without warranty of any kind"],
}
_TAIL = {"spdx": (5, 0.99), "url": (5, 0.97), "versioned": (4, 0.95), "short": (3, 0.85), "phrase": (2, 0.7),
         "notice": (1, 0.3)}


def _rule(label: str, pattern: str, keywords: tuple[str, ...], kind: str) -> Rule:
    return Rule(label, pattern, keywords, *_TAIL[kind])


def _version(v: str) -> str:
    """Pattern of a version number; a trailing .0 may be left out."""
    whole = re.escape(v.removesuffix(".0"))
    return whole + r"(?:\.0)?(?!\.?[0-9])" if v.endswith(".0") or "." not in v else whole + r"(?!\.?[0-9])"


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: templates filled with the names and versions above."""
    out = [_rule(x, r"spdx license identifier " + re.escape(x) + r"(?:-only|-or-later|\+)?(?![0-9a-z.-]*[0-9a-z])",
                 ("spdx",), "spdx") for x in SPDX]
    for (short, name), v in product(GNU.items(), GNU_VERSIONS):
        out += [_rule(f"{short}-{v}", rf"(?:gnu )?{name} licen[cs]e (?:v|version )? ?{_version(v)}", (name.split()[-1], "licen"), "versioned"),
                _rule(f"{short}-{v}", rf"{short}[ -]?v?{_version(v)}", (short,), "short")]
    for (short, name), v in product(CC.items(), CC_VERSIONS):
        out += [_rule(f"cc-{short}-{v}", rf"creativecommons\.org/licenses/{short}/{re.escape(v)}", ("creativecommons",), "url"),
                _rule(f"cc-{short}-{v}", rf"cc {short.replace('-', ' ')} {_version(v)}", ("cc",), "versioned"),
                _rule(f"cc-{short}-{v}", rf"creative commons {name} {_version(v)}", ("creative", "commons"), "versioned")]
    for short, name in CC.items():
        out += [_rule(f"cc-{short}", rf"creative commons {name}", ("creative", "commons"), "short"),
                _rule(f"cc-{short}", rf"cc {short.replace('-', ' ')}", ("cc",), "short")]
    for short, (name, versions) in VERSIONED.items():
        out += [_rule(short, rf"{name} licen[cs]e", (name.split()[-1], "licen"), "phrase")]
        for v in versions:
            out += [_rule(f"{short}-{v.removesuffix('.0')}", rf"{name} licen[cs]e (?:v|version )? ?{_version(v)}", (name.split()[-1], "licen"), "versioned"),
                    _rule(f"{short}-{v.removesuffix('.0')}", rf"{short}[ -]v?{_version(v)}", (short,), "short")]
    for label, phrases in PHRASES.items():
        kind = "notice" if label in ("license-notice", "copyleft") else "phrase"
        out += [_rule(label, re.escape(p).replace(r"\ ", " "), (p.split()[0], p.split()[-1]), kind) for p in phrases]
    return tuple(out)


@cache
def _compiled():
    """(rule, regex) pairs, the keyword automaton and, for each rule, its keywords."""
    import ahocorasick

    found = []
    for r in rules():
        body = re.sub(r"(?<!\[) (?!\?|-)", lambda _: _GAP, r.pattern)
        found.append((r, re.compile(_OPEN + body + _CLOSE)))
    machine = ahocorasick.Automaton()
    for word in {k for r in rules() for k in r.keywords}:
        machine.add_word(word, word)
    machine.make_automaton()
    by_word: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        by_word.setdefault(r.keywords[0], []).append(i)
    base = [(label, re.compile(_OPEN + _GAP.join(p.split()) + _CLOSE), p.split()) for label, p in BASE.items()]
    return found, machine, by_word, base


def resolve(found: list[tuple[int, int, int, float, str]]) -> list[tuple[int, int, int, float, str]]:
    """Detections (start, stop, priority, confidence, label) without those that lie inside
    another of at least their priority; of equal ones the first label stays."""
    kept, reach = [], {}
    for d in sorted(set(found), key=lambda d: (d[0], -d[1], -d[2], d[4])):
        if not any(stop >= d[1] for p, stop in reach.items() if p >= d[2]):
            kept.append(d)
            reach[d[2]] = max(reach.get(d[2], -1), d[1])
    return kept


def detect(view: str, gated: bool = True) -> list[tuple[int, int, int, float, str]]:
    """Detections in one lower-cased text (a Latin-1 view of its UTF-8 bytes): keyword gate, rules, resolution.

    The keywords of a rule are single words that each of its matches holds, so the gate changes no result."""
    found, machine, by_word, _ = _compiled()
    present = {word for _, word in machine.iter(view)} if gated else {k for r in rules() for k in r.keywords}
    hits = []
    for word in present:
        for i in by_word.get(word, ()):
            rule, regex = found[i]
            if all(k in present for k in rule.keywords):
                hits += [(m.start(), m.end(), rule.priority, rule.confidence, rule.label) for m in regex.finditer(view)]
    return resolve(hits)


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("stop_word", pa.int64()),
                             ("priority", pa.int32()), ("confidence", pa.float64()), ("base", pa.bool_())]))


def _scan(names: list[str]):
    def groups(texts):
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t) if t else 0
            if size >= SCAN_BYTES or i == len(texts) - 1:
                yield at, i + 1
                at, size = i + 1, 0

    def run(batches):
        _, machine, _, base = _compiled()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            words, found = [], []
            for lo, hi in groups(texts):
                data, offsets = joined_bytes(texts[lo:hi])
                data = LOWER[data]
                start, _, doc = word_spans(data, offsets, ALNUM)
                per = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(per) - per
                words += per.tolist()
                own: list[list[dict]] = [[] for _ in range(hi - lo)]
                view = data.tobytes().decode("latin-1")
                for label, regex, phrase in base:
                    if phrase[-1] in view:
                        for m in regex.finditer(view):
                            w = int(np.searchsorted(start, m.start()))
                            d = int(doc[w])
                            if doc[w + len(phrase) - 1] == d:  # a phrase does not run on into the next text
                                own[d].append({"label": label, "first_word": w - int(first[d]), "stop_word": w - int(first[d]) + len(phrase),
                                               "priority": 9, "confidence": BASE_CONFIDENCE, "base": True})
                gate = sorted({int(np.searchsorted(offsets, at, "right")) - 1 for at, _ in machine.iter(view)})
                for d in gate:
                    text = view[offsets[d]:offsets[d + 1] - 1]
                    for a, b, priority, confidence, label in detect(text):
                        w, v = np.searchsorted(start, [offsets[d] + a, offsets[d] + b]).tolist()
                        own[d].append({"label": label, "first_word": w - int(first[d]), "stop_word": v - int(first[d]),
                                       "priority": priority, "confidence": confidence, "base": False})
                found += own
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(words, pa.int64()), pa.array(found, _FOUND)],
                                             [*names, "lic_n_words", "lic_found"])
    return run


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` (any columns, among them ``text``) with ``lic_n_words`` and ``lic_found``: the
    detections (label, word range, priority, confidence, base).  Input columns of those names are replaced."""
    names = [c for c in docs.columns if c not in ("lic_n_words", "lic_found")]
    hit = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                        T.StructField("stop_word", T.LongType()), T.StructField("priority", T.IntegerType()),
                        T.StructField("confidence", T.DoubleType()), T.StructField("base", T.BooleanType())])
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("lic_n_words", T.LongType()),
                                                             T.StructField("lic_found", T.ArrayType(hit))])
    return docs.select(*names).mapInArrow(_scan(names), schema)


def q_licenses(spark, sf_dir: str) -> DataFrame:
    from .common import table
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("lic_found", lambda x: x["base"])
    names = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["first_word"])
    doubt = F.aggregate(F.col("lic_found"), F.lit(1.0), lambda a, x: a * (1 - x["confidence"]))
    return found.select("doc_id", F.col("lic_n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        names(base).alias("base_labels"), names(F.col("lic_found")).alias("labels"), (1 - doubt).alias("score"))
