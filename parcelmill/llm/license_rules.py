"""License scans by ordered signature rules.

Rules are regular expressions over the lower-cased text, each gated by keywords of which whatever it matches
holds one: one Aho-Corasick pass over a text finds the keywords it holds, and only their rules run. A detection that lies inside one of
higher priority (or of equal priority, where it is shorter or later in the order of rules) is suppressed.
"""

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm.common import utf8

#: Fixed phrases, matched on whole words, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Families: label, keyword (or several with | between them; every form of the name holds one), name of the license as a
#: regular expression (a blank is any white space).
FAMILIES = [
    ("mit", "mit", r"(?:the )?mit(?: \(expat\)| expat)? licen[sc]e"),
    ("mit-0", "mit no attribution", r"mit no attribution(?: licen[sc]e)?"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e,? (?:version )?1\.1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[sc]e,? (?:version |v)?2(?:\.0)?"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified|2-clause|two-clause|freebsd) bsd licen[sc]e|bsd 2-clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3-clause|three-clause) bsd licen[sc]e|bsd 3-clause(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original|4-clause|four-clause) bsd licen[sc]e|bsd 4-clause(?: licen[sc]e)?"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[sc]e"),
    ("0bsd", "zero", r"zero-clause bsd(?: licen[sc]e)?|bsd zero clause(?: licen[sc]e)?"),
    ("isc", "isc", r"(?:the )?isc licen[sc]e"),
    ("agpl-3.0", "affero", r"gnu affero general public licen[sc]e,? (?:version |v)?3(?:\.0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("lgpl-2.1", "gnu", r"gnu (?:lesser|library) general public licen[sc]e,? (?:version |v)?2\.1"),
    ("lgpl-3.0", "gnu", r"gnu lesser general public licen[sc]e,? (?:version |v)?3(?:\.0)?"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[sc]e,? (?:version |v)?2(?:\.0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[sc]e,? (?:version |v)?3(?:\.0)?"),
    ("gpl", "gnu gpl", r"gnu gpl(?: licen[sc]e)?"),
    ("gfdl", "free documentation", r"gnu free documentation licen[sc]e"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? (?:version |v)?1\.1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? (?:version |v)?2(?:\.0)?"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e,? (?:version |v)?1(?:\.0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e,? (?:version |v)?2(?:\.0)?"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e"),
    ("cddl-1.0", "development and distribution", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common public", r"common public licen[sc]e"),
    ("cpal-1.0", "attribution", r"common public attribution licen[sc]e"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e,? (?:version |v)?2(?:\.0)?"),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e"),
    ("busl-1.1", "business source", r"business source licen[sc]e"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "what the", r"do what the fuck you want to public licen[sc]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1\.0)?(?: universal)?"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution-noncommercial-noderiv(?:ative)?s?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution-noncommercial-share ?alike"),
    ("cc-by-nc", "creative commons", r"creative commons attribution-noncommercial"),
    ("cc-by-nd", "creative commons", r"creative commons attribution-noderiv(?:ative)?s?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution-share ?alike"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("cc", "creative commons", r"creative commons licen[sc]e"),
    ("odbl-1.0", "open database|open data commons", r"open (?:data commons )?database licen[sc]e"),
    ("odc-by", "open data commons", r"open data commons attribution licen[sc]e"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e"),
    ("ogl-uk", "open government", r"open government licen[sc]e"),
    ("python-2.0", "python|psf", r"python software foundation licen[sc]e|psf licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e"),
    ("w3c", "w3c", r"w3c (?:software )?(?:notice and )?licen[sc]e"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("osl-3.0", "open software", r"open software licen[sc]e"),
    ("afl-3.0", "academic", r"academic free licen[sc]e"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e"),
    ("beerware", "beer", r"beer-?ware licen[sc]e"),
    ("public-domain", "public domain", r"(?:in|into) the public domain"),
]

#: Forms in which a family is named: suffix of the rule, frame around the name, priority, strength.
FORMS = [
    ("grant", r"(?:licen[sc]ed|released|distributed|available|published|provided|redistributed?) under (?:the terms (?:and conditions )?of )?(?:the |an? )?(?:{name})", 80, 0.95),
    ("subject", r"(?:subject to|governed by|according to|in accordance with|covered by) (?:the terms of )?(?:the |an? )?(?:{name})", 70, 0.85),
    ("file", r"(?:see|refer to) (?:the )?(?:licen[sc]e|copying|notice)(?: file)? for (?:the )?(?:{name})", 65, 0.85),
    ("name", r"(?:{name})", 50, 0.6),
]

#: Sentences, tags and addresses that name a license by themselves: label, keyword, expression, priority, strength.
TEXTS = [
    ("mit", "free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy", 90, 0.95),
    ("isc", "with or without fee", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", 90, 0.95),
    ("bsd", "source and binary", r"redistribution and use in source and binary forms, with or without modification", 90, 0.95),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived", 85, 0.8),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features", 90, 0.9),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such", 90, 0.9),
    ("bsl-1.0", "machine-executable", r"machine-executable object code generated by a source language processor", 90, 0.9),
    ("gpl", "free software foundation", r"as published by the free software foundation", 60, 0.8),
    ("gpl", "any later version", r"(?:either )?version [0-9.]+ of the license,? or (?:\(at your option\) )?any later version", 75, 0.9),
    ("gpl", "fitness for a particular", r"without even the implied warranty of merchantability or fitness for a particular purpose", 55, 0.5),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 95, 0.95),
    ("cc0-1.0", "waived all copyright", r"waived all copyright and related or neighbou?ring rights", 90, 0.95),
    ("mpl-2.0", "mozilla public", r"subject to the terms of the mozilla public license, v\. 2\.0", 90, 0.95),
    ("apache-2.0", "apache.org/licenses", r"https?://(?:www\.)?apache\.org/licenses/license-2\.0", 95, 0.95),
    ("mit", "opensource.org", r"https?://(?:www\.)?opensource\.org/licenses?/mit", 95, 0.95),
    ("bsd", "opensource.org", r"https?://(?:www\.)?opensource\.org/licenses?/bsd", 95, 0.95),
    ("gpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl", 95, 0.95),
    ("lgpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl", 95, 0.95),
    ("agpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/agpl", 95, 0.95),
    ("cc", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/[a-z-]+", 60, 0.8),
    ("cc-by", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by(?:/|\b)(?!-)[0-9./]*", 95, 0.95),
    ("cc-by-sa", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by-sa[0-9./]*", 95, 0.95),
    ("cc-by-nc", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by-nc(?!-)[0-9./]*", 95, 0.95),
    ("cc-by-nd", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by-nd[0-9./]*", 95, 0.95),
    ("cc-by-nc-sa", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by-nc-sa[0-9./]*", 95, 0.95),
    ("cc-by-nc-nd", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/licenses/by-nc-nd[0-9./]*", 95, 0.95),
    ("cc0-1.0", "creativecommons.org", r"https?://(?:www\.)?creativecommons\.org/publicdomain/zero[0-9./]*", 95, 0.95),
    ("cc-by", "cc", r"\bcc[ -]by(?:[ -][1-4]\.0)?\b(?![ -](?:nc|nd|sa))", 50, 0.6),
    ("cc-by-sa", "cc", r"\bcc[ -]by[ -]sa(?:[ -][1-4]\.0)?\b", 55, 0.7),
    ("cc-by-nc", "cc", r"\bcc[ -]by[ -]nc(?:[ -][1-4]\.0)?\b(?![ -](?:nd|sa))", 55, 0.7),
    ("cc-by-nd", "cc", r"\bcc[ -]by[ -]nd(?:[ -][1-4]\.0)?\b", 55, 0.7),
    ("cc-by-nc-sa", "cc", r"\bcc[ -]by[ -]nc[ -]sa(?:[ -][1-4]\.0)?\b", 60, 0.7),
    ("cc-by-nc-nd", "cc", r"\bcc[ -]by[ -]nc[ -]nd(?:[ -][1-4]\.0)?\b", 60, 0.7),
    ("reserved", "all rights", r"\ball rights reserved\b", 40, 0.5),
    ("copyright", "copyright", r"\bcopyright (?:\(c\) |© )?(?:19|20)[0-9]{2}\b", 30, 0.3),
    ("copyright", "©", r"© ?(?:19|20)[0-9]{2}\b", 30, 0.3),
    ("proprietary", "proprietary", r"\bproprietary and confidential\b", 70, 0.7),
    ("proprietary", "not be copied|not be reproduced|not be distributed", r"\b(?:may not|must not) be (?:copied|reproduced|distributed)[^.]{0,80} without (?:the )?(?:prior )?(?:written )?permission\b", 70, 0.7),
]


class Rule(NamedTuple):
    name: str
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    strength: float


class Found(NamedTuple):
    start: int
    stop: int
    order: int


def _compiled(expression: str) -> re.Pattern:
    return re.compile(expression.replace(" ", r"\s+"))


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in their order: tags, then addresses and sentences, then names by form."""
    tags = [
        Rule(f"{label}:tag", label, "spdx-license-identifier", _compiled(rf"spdx-license-identifier: ?\(?{re.escape(label)}(?:-only|-or-later|\+)?(?![\w.-])"), 100, 1.0)
        for label in dict.fromkeys(f[0] for f in FAMILIES)
    ]
    texts = [Rule(f"{label}:text{k}", label, keyword, _compiled(e), priority, strength) for k, (label, keyword, e, priority, strength) in enumerate(TEXTS)]
    named = [
        # a longer name outranks the shorter one it holds through containment; both ends are at word borders
        Rule(f"{label}:{form}", label, keyword, _compiled(rf"(?<!\w){frame.format(name=name)}(?!\w)"), priority, strength)
        for form, frame, priority, strength in FORMS
        for label, keyword, name in FAMILIES
    ]
    return tuple(tags + texts + named)


@cache
def _gate() -> tuple[ahocorasick.Automaton, dict[str, list[int]]]:
    by_keyword: dict[str, list[int]] = {}
    for k, rule in enumerate(rules()):
        for keyword in rule.keyword.split("|"):
            by_keyword.setdefault(keyword, []).append(k)
    gate = ahocorasick.Automaton()
    for keyword in by_keyword:
        gate.add_word(keyword, keyword)
    gate.make_automaton()
    return gate, by_keyword


def opened(low: str) -> list[int]:
    """Rules of which a lower-cased text holds a keyword: all that can match, and others."""
    gate, by_keyword = _gate()
    # keywords hold single blanks: look for them where each run of white space (as `\s` has it) is a blank
    flat = " ".join(low.split())
    return sorted({k for keyword in {word for _, word in gate.iter(flat)} for k in by_keyword[keyword]})


def detections(low: str, gated: bool = True) -> list[Found]:
    """Detections in a lower-cased text that no other suppresses, by place; without the gate all rules run."""
    open_rules = opened(low) if gated else range(len(rules()))
    every = [Found(m.start(), m.end(), k) for k in open_rules for m in rules()[k].pattern.finditer(low) if m.end() > m.start()]
    # by start, longest first: what contains a detection stands before it; of equal spans the better rule first
    every.sort(key=lambda f: (f.start, -f.stop, -rules()[f.order].priority, f.order))
    kept: list[Found] = []
    around: list[Found] = []  # of those before, the ones that reach beyond this start
    for f in every:
        around = [g for g in around if g.stop > f.start]
        if not any(g.stop >= f.stop and rules()[g.order].priority >= rules()[f.order].priority for g in around):
            kept.append(f)
        around.append(f)
    return kept


#: Everything but letters a-z, digits and non-ASCII characters becomes a blank, A-Z become a-z.
_WORDS = bytes(ord(chr(c).lower()) if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_PHRASES = {f" {p} ".encode(): label for p, label in PHRASES.items()}


def phrases(words: bytes) -> tuple[int, int | None, int | None, set[str]]:
    """Places of the fixed phrases in words that are joined, begun and ended by one blank: their number,
    first and last word, and labels."""
    first = last = None
    n, labels = 0, set()
    for phrase, label in _PHRASES.items():
        at, before, word = words.find(phrase), 0, 0
        while at >= 0:
            word, before = word + words.count(b" ", before, at), at  # blanks since the last place
            n, first, last = n + 1, word if first is None else min(first, word), word if last is None else max(last, word)
            labels.add(label)
            at = words.find(phrase, at + 1)
    return n, first, last, labels


def scan(text: str | None) -> dict:
    """Everything about one text; an empty one and a null one have no words and score 0."""
    raw = utf8(text)
    words = raw.translate(_WORDS).split()
    n, first, last, base = phrases(b" %b " % b" ".join(words))
    found = detections(raw.lower().decode("utf-8", "surrogatepass"))
    doubt = 0.5 if base else 1.0
    for f in found:
        doubt *= 1 - rules()[f.order].strength
    return {
        "n_words": len(words), "n_base": n, "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {rules()[f.order].label for f in found})),
        "score": 1 - doubt,
        "detections": [{"start": f.start, "stop": f.stop, "rule": rules()[f.order].name} for f in found],
    }


_KINDS = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double", "detections": "array<struct<start:int,stop:int,rule:string>>"}


def _scans(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        out = pd.DataFrame([scan(t) for t in part], columns=list(_KINDS))
        yield out.astype({"first_word": "Int64", "last_word": "Int64"})


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, word and phrase counts, labels, `score` and `detections` (spans and rules).

    Null texts count as empty. Repeated rows each get a row; other columns are left out; no rows give no
    rows. One pass over whole texts, nothing is shuffled.
    """
    run = pandas_udf(_scans, ", ".join(f"{k} {v}" for k, v in _KINDS.items())).asNondeterministic()
    return docs.select(F.col(doc_id).alias("doc_id"), run(text).alias("s")).select("doc_id", "s.*")
