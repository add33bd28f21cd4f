"""
License scan: ordered signature rules over the words of a text.

A rule is a regex over lower-cased words with one marked key word (``@``). The key words are
the prefilter: a document's words are met with them in one pass, and a rule's regex runs only
on the words around its key, and only if its gate word stands there too. A detection inside
another one of at least its length is suppressed; of equal ranges the rule listed first stays.
The base phrases are always reported. Only DataFrame operations are used.

Null and empty texts have no words and no detections (labels ``""``, score 0). Very long texts are read
whole. Of rules that fit the same range with the same priority the longer fit counts. One row per
distinct (doc_id, text); an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.base import SENTINEL, ascii_lower, scan_words

# The base phrases and their labels.
BASE = (
    ("mit", "under the mit @license"),
    ("apache-2", "@apache license version 2"),
    ("cc-by-nc", "@cc by nc"),
)

V = "(?: v| version)? ?"
# Families of numbered licenses: what their short name is, and the versions that are told apart.
NUMBERED = (
    ("agpl", ("1", "3")), ("lgpl", ("2 1", "2", "3")), ("gpl", ("1", "2", "3")), ("mpl", ("1 1", "2")), ("epl", ("1", "2")),
    ("eupl", ("1 1", "1 2")), ("lppl", ("1 3",)), ("cddl", ("1",)), ("osl", ("3",)), ("afl", ("3",)), ("ecl", ("2",)), ("upl", ("1",)),
)
# label: signature with its key word marked; the first that fits a range wins. "license" stands for either spelling.
SIGNATURES = (
    ("agpl-3", f"gnu affero general public @license{V}3"), ("agpl-1", f"affero general public @license{V}1"),
    ("agpl", "affero general public @license"),
    ("lgpl-3", f"gnu (?:lesser|library) general public @license{V}3"), ("lgpl-2.1", f"gnu lesser general public @license{V}2 1"),
    ("lgpl-2", f"gnu library general public @license{V}2"), ("lgpl", "(?:lesser|library) general public @license"),
    ("gpl-3", f"(?:gnu )?general public @license{V}3"), ("gpl-2", f"(?:gnu )?general public @license{V}2"),
    ("gpl-1", f"gnu general public @license{V}1"), ("gpl", "gnu general public @license"),
    *((f"{name}-{v.replace(' ', '.')}", f"@{name}{V}{v}") for name, versions in NUMBERED for v in versions),
    *((f"{name}-{v.replace(' ', '.')}", f"@{name}{mark}{v}") for name, versions in NUMBERED for v in versions for mark in ("", "v")),
    ("gfdl", "gnu free documentation @license"), ("gfdl", "@gfdl"),
    ("apache-2", f"@apache license{V}2"), ("apache-2", "@apache 2 0"), ("apache-2", "@apache 2 license"), ("apache-2", "@apache2 license"),
    ("apache-1.1", f"@apache (?:software )?license{V}1 1"),
    ("apache-1", f"@apache (?:software )?license{V}1 0"), ("apache", "@apache (?:software )?license"),
    ("mit-0", "mit no attribution @license"), ("mit-0", "@mit 0 license"), ("mit", "mit(?: style)? @license"), ("mit", "@expat license"),
    ("mit", "massachusetts institute of technology @license"), ("x11", "x11 @license"),
    ("0bsd", "zero clause @bsd"), ("0bsd", "@0bsd"), ("bsd-1", "@bsd 1 clause(?: license)?"),
    ("bsd-3-clear", "clear @bsd(?: license)?"), ("bsd-protection", "@bsd protection license"),
    ("bsd-2", "@bsd 2 clause(?: license)?"), ("bsd-3", "@bsd 3 clause(?: license)?"), ("bsd-4", "@bsd 4 clause(?: license)?"),
    ("bsd-2", "(?:2|two) clause @bsd(?: license)?"), ("bsd-3", "(?:3|three) clause @bsd(?: license)?"),
    ("bsd-4", "(?:4|four) clause @bsd(?: license)?"),
    ("bsd-2", "(?:simplified|freebsd) @bsd(?: license)?"), ("bsd-2", "freebsd @license"),
    ("bsd-3", "(?:new|modified|revised) @bsd(?: license)?"), ("bsd-4", "(?:original|old) @bsd(?: license)?"),
    ("bsd", "@bsd(?: style)? license"), ("isc", "isc @license"), ("zlib", "zlib(?: libpng)? @license"), ("libpng", "libpng @license"),
    ("bsl", "boost software @license"), ("bsl", "boost @license"),
    ("mpl-2", f"mozilla public @license{V}2"), ("mpl-1.1", f"mozilla public @license{V}1 1"), ("mpl-1", f"mozilla public @license{V}1 0"),
    ("mpl", "mozilla public @license"), ("npl", "netscape public @license"),
    ("epl-2", f"eclipse public @license{V}2"), ("epl-1", f"eclipse public @license{V}1"), ("epl", "eclipse public @license"),
    ("edl", "eclipse distribution @license"), ("eupl", "european union public @license"), ("cpl", "common public @license"),
    ("cpal", "common public attribution @license"), ("ipl", "ibm public @license"),
    ("cddl", "common development and distribution @license"),
    ("artistic-2", f"artistic @license{V}2"), ("artistic-1", f"artistic @license{V}1"), ("artistic", "artistic @license"),
    ("perl", "same terms as @perl itself"), ("python", "python software foundation @license"), ("python", "psf @license"),
    ("cnri-python", "cnri python @license"), ("ruby", "ruby @license"), ("php", "php @license"), ("zpl", "zope public @license"),
    ("postgresql", "postgresql @license"), ("openssl", "openssl @license"), ("ssleay", "ssleay @license"), ("curl", "curl @license"),
    ("openldap", "openldap public @license"), ("sleepycat", "sleepycat @license"), ("vim", "vim @license"), ("tcl", "tcl(?: tk)? @license"),
    ("freetype", "freetype(?: project)? @license"), ("ijg", "independent jpeg group @license"), ("info-zip", "info zip @license"),
    ("imagemagick", "imagemagick @license"), ("unicode", "unicode(?: terms of use)? @license"), ("icu", "icu @license"),
    ("w3c", "w3c(?: software)?(?: notice and)? @license"), ("ntp", "ntp @license"), ("json", "json @license"), ("hpnd", "historical permission notice and @disclaimer"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)? @license"), ("ncsa", "illinois open source @license"),
    ("ecl", "educational community @license"), ("efl", "eiffel forum @license"), ("fair", "fair @license"), ("beerware", "@beerware"),
    ("beerware", "beer ware @license"), ("ms-pl", "microsoft public @license"), ("ms-rl", "microsoft reciprocal @license"),
    ("ms-lpl", "microsoft limited public @license"), ("apsl", "apple public source @license"), ("spl", "sun public @license"),
    ("sissl", "sun industry standards source @license"), ("nokia", "nokia open source @license"), ("qpl", "q public @license"),
    ("intel", "intel open source @license"), ("lucent", "lucent public @license"), ("ricoh", "ricoh source code public @license"),
    ("sgi-b", "sgi free software @license"), ("nasa", "@nasa open source agreement"), ("naumen", "naumen public @license"),
    ("motosoto", "motosoto open source @license"), ("watcom", "sybase open watcom public @license"), ("xnet", "x net @license"),
    ("aal", "attribution assurance @license"), ("apl", "adaptive public @license"), ("cua", "cua office public @license"),
    ("frameworx", "frameworx(?: open)? @license"), ("lppl", "latex project public @license"), ("rpl", "reciprocal public @license"),
    ("entessa", "entessa public @license"), ("wxwindows", "wxwindows library @license"), ("yahoo", "yahoo public @license"),
    ("zimbra", "zimbra public @license"), ("simple-2", "simple public @license"), ("upl", "universal permissive @license"),
    ("blueoak", "blue oak model @license"), ("mulan", "mulan(?: permissive software| psl) @license"), ("cecill-b", "cecill b @license"),
    ("cecill-c", "cecill c @license"), ("cecill", "cecill(?: free software)? @license"), ("oset", "oset public @license"),
    ("osl", "open software @license"), ("afl", "academic free @license"), ("nposl", "non profit open software @license"),
    ("sspl", "server side public @license"), ("sspl", "@sspl"), ("elastic", "elastic @license"), ("busl", "business source @license"),
    ("busl", "@busl"), ("commons-clause", "@commons clause"), ("polyform-nc", "polyform noncommercial @license"),
    ("polyform", "polyform [a-z]+(?: [a-z]+)? @license"), ("confluent", "confluent community @license"), ("timescale", "timescale @license"),
    ("prosperity", "prosperity public @license"), ("parity", "parity public @license"), ("hippocratic", "hippocratic @license"),
    ("jrl", "java research @license"), ("oracle-bcl", "oracle binary code @license"), ("cern-ohl", "cern open hardware(?: licence)? @license"),
    ("cern-ohl", "cern open hardware @license"), ("tapr-ohl", "tapr open hardware @license"), ("solderpad", "solderpad(?: hardware)? @license"),
    ("ofl", "(?:sil )?open font @license"), ("ofl", "sil @ofl"), ("ubuntu-font", "ubuntu font @license"), ("gust-font", "gust font @license"),
    ("bitstream-vera", "bitstream @vera fonts copyright"), ("odbl", "open database @license"), ("odbl", "@odbl"),
    ("odc-by", "open data commons attribution @license"), ("pddl", "public domain dedication and @license"), ("pddl", "@pddl"),
    ("cdla-permissive", "community data @license agreement permissive"), ("cdla-sharing", "community data @license agreement sharing"),
    ("cdla", "community data @license agreement"), ("ogl-uk", "open government @license"), ("etalab", "@etalab open license"),
    ("dl-de-by", "data @license germany attribution"), ("nlod", "norwegian @license for open government data"), ("free-art", "free art @license"),
    ("dsl", "design science @license"), ("openrail-m", "(?:creativeml )?open rail(?: [+]+)? ?m @license"), ("openrail", "@openrail"),
    ("openrail", "responsible ai @license"), ("bloom-rail", "bigscience(?: bloom)? rail @license"), ("llama", "llama(?: [0-9]+)*(?: community)? @license"),
    ("gemma", "@gemma terms of use"), ("ai2-impact", "ai2 impact @license"), ("opl", "open publication @license"), ("oclc", "oclc research public @license"),
    ("ogl", "open game @license"), ("dfsl", "deutsche freie software @license"), ("oldap", "@oldap"), ("liliq", "licence libre du @quebec"),
    ("unlicense", "the @unlicense"), ("unlicense", "@unlicense license"), ("wtfpl", "@wtfpl(?:v2)?"), ("wtfpl", "@wtfplv2"),
    ("wtfpl", "do what the @fuck you want to public license"), ("cc-pdm", "public domain @mark 1 0"),
    ("cc0", "@cc0"), ("cc0", "@cc 0 1 0"), ("cc0", "@creative commons zero"), ("cc0", "@creative commons 0"),
    *((f"cc-by{s}", "@cc by" + s.replace("-", " ")) for s in ("-nc-sa", "-nc-nd", "-nc", "-sa", "-nd")),
    ("cc-by", "@cc by (?:1|2|2 5|3|4)(?: 0)?(?: license)?"), ("cc-by", "@cc by license"), ("cc-by", "license @cc by"),
    *((f"cc-by{s}", "@creative commons attribution" + t) for s, t in (
        ("-nc-sa", " non ?commercial share ?alike"), ("-nc-nd", " non ?commercial no ?deriv(?:ative)?s?"),
        ("-nc", " non ?commercial"), ("-sa", " share ?alike"), ("-nd", " no ?deriv(?:ative)?s?"), ("", ""))),
    ("cc", "creative commons @license"),
    ("proprietary", "all rights @reserved"), ("proprietary", "proprietary and @confidential"),
    ("proprietary", "confidential and @proprietary"), ("proprietary", "commercial @license agreement"), ("eula", "end user @license agreement"),
)
# Names that are plain words as well: only after a grant.
GRANTED = (
    ("apache-2", "@apache 2"), ("apache", "@apache"), ("mit", "@mit"), ("bsd", "@bsd"), ("gpl", "@gpl"), ("lgpl", "@lgpl"), ("agpl", "@agpl"),
    ("isc", "@isc"), ("zlib", "@zlib"), ("mpl", "@mpl"), ("cc0", "@cc 0"), ("cc-by", "@cc by"), ("artistic", "@artistic"),
    ("public-domain", "public @domain"),
)
# Grant, condition and warranty sentences of texts that need not name their license.
WORDINGS = (
    ("mit", "free of charge to any person @obtaining a copy of this software"),
    ("mit", "above copyright notice and this permission notice shall be @included in all copies or substantial portions"),
    ("mit", "software is provided as is without warranty of any kind @express or implied"),
    ("ofl", "free of charge to any person @obtaining a copy of the font software"),
    ("bsl", "any person or organization @obtaining a copy of the software and accompanying documentation"),
    ("isc", "permission to use copy modify (?:and )?(?:or )?@distribute this software for any purpose with or without fee"),
    ("bsd-4", "all @advertising materials mentioning features or use of this software"),
    ("bsd-3", "be used to @endorse or promote products derived from this software"),
    ("bsd", "redistribution and use in source and @binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must @retain the above copyright notice"),
    ("bsd", "redistributions in binary form must @reproduce the above copyright notice"),
    ("bsd", "provided by the copyright holders and @contributors as is and any express or implied warranties"),
    ("zlib", "software is provided as is without any express or implied @warranty"),
    ("zlib", "origin of this software must not be @misrepresented"),
    ("zlib", "altered source versions must be plainly @marked as such"),
    ("apache-2", "may not use this file except in @compliance with the license"),
    ("apache-2", "on an as is basis without warranties or @conditions of any kind"),
    ("agpl", "redistribute it and or @modify it under the terms of the gnu affero general"),
    ("lgpl", "redistribute it and or @modify it under the terms of the gnu (?:lesser|library) general"),
    ("gpl", "redistribute it and or @modify it under the terms of the gnu general public"),
    ("lgpl", "library is distributed in the hope that it will be @useful but without any warranty"),
    ("gpl", "program is distributed in the hope that it will be @useful but without any warranty"),
    ("mpl", "source code form is subject to the terms of the @mozilla public"),
    ("unlicense", "free and unencumbered software @released into the public domain"),
    ("cc0", "waived all copyright and related or @neighboring rights"),
    ("mit", "rights to use copy modify merge publish distribute @sublicense and or sell copies"),
    ("mit-0", "use copy modify merge publish distribute sublicense and or sell copies of the software and to @permit persons"),
    ("isc", "the software is provided as is and the author @disclaims all warranties with regard to this software"),
    ("apache-2", "hereby grants to you a perpetual worldwide non exclusive no charge @royalty free irrevocable copyright license"),
    ("apache-2", "unless required by @applicable law or agreed to in writing software distributed under the license"),
    ("apache-1.1", "this product includes software developed by the @apache software foundation"),
    ("mpl-2", "if a copy of the @mpl was not distributed with this file"),
    ("mpl-1.1", "the contents of this file are subject to the @mozilla public license version 1 1"),
    ("epl", "this program and the @accompanying materials are made available under the terms of the eclipse public"),
    ("cddl", "the contents of this file are @subject to the terms of the common development and distribution"),
    ("gpl", "you should have received a copy of the @gnu general public"), ("lgpl", "you should have received a copy of the @gnu lesser general public"),
    ("agpl", "you should have received a copy of the @gnu affero general public"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the @gnu free documentation"),
    ("unlicense", "anyone is free to copy modify publish use @compile sell or distribute this software"),
    ("wtfpl", "you just do what the @fuck you want to"), ("beerware", "you can buy me a @beer in return"),
    ("boost", "boost org license 1 0 @txt"), ("zlib", "not claim that you @wrote the original software"),
    ("postgresql", "in no event shall the university of california be @liable to any party"),
    ("openssl", "product includes software developed by the @openssl project"),
    ("php", "product includes @php software freely available from"), ("python", "psf is making python available to @licensee on an as is basis"),
    ("cc-by", "this work is licensed under a creative commons attribution [0-9] [0-9] @international"),
    ("cc-by-sa", "text is available under the creative @commons attribution share ?alike"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly @prohibited"),
    ("proprietary", "no part of this publication may be @reproduced"), ("proprietary", "this software is the confidential and @proprietary information of"),
)
# What may stand before a signature, and how sure that makes the rule.
GRANTS = (
    ("(?:licensed|released|distributed|published|provided|available) under (?:the )?(?:terms of (?:the )?)?", 1.0),
    ("spdx license identifier ", 1.0),
    ("under (?:the )?(?:terms of (?:the )?)?", 0.9),
    ("", 0.7),
)
BEFORE, AFTER = 24, 14


def _spelled(signature: str) -> str:
    """The signature with either spelling of a license."""
    return re.sub(r"(?<![a-z])license(?![a-z])", "licen[cs]e", signature)


def _keys(signature: str) -> tuple[str, ...]:
    """The marked word in its spellings."""
    if "@licen[cs]e" in signature:
        return ("license", "licence")
    return (re.match("[a-z0-9]+", signature.split("@", 1)[1])[0],)


def _gate(signature: str) -> str:
    """A further word that must stand near the key: the longest plain one, or none."""
    plain = [w for w in signature.replace("@", " @").split() if w.isascii() and w.isalnum()]
    return max(plain, key=len, default="")


def rules() -> list[tuple]:
    """(priority, label, key word, gate word, regex, confidence, base) in order of priority."""
    out = [(label, _keys(s)[0], "", s, 1.0, True) for label, s in BASE]
    for grant, sure in GRANTS:
        for label, signature in (*SIGNATURES, *(GRANTED if grant else ())):
            body = _spelled(signature)
            out += [(label, key, _gate(body), grant + body, sure, False) for key in _keys(body)]
    for label, signature in WORDINGS:
        body = _spelled(signature)
        out += [(label, key, _gate(body), body, 0.8, False) for key in _keys(body)]
    # U+0085, U+2028 and U+2029 are parts of words; `.` without (?s), and `$`, take them for line ends.
    return [(n, label, key, gate, rf"(?s)^((?:.* )??)({body})(?: .*)?\z", sure, base)
            for n, (label, key, gate, body, sure, base) in enumerate(out)]


def rule_table(spark: SparkSession) -> DataFrame:
    schema = ("priority int, label string, word string, gate string, regex string, confidence double, base boolean")
    return spark.createDataFrame([*rules(), (-1, "", SENTINEL, "", "^()()$", 0.0, False)], schema)


def detections(docs: DataFrame) -> DataFrame:
    """
    Every fit of every rule: ``doc_id, text_key, n_words, label, start, end`` (words, end
    exclusive), ``confidence, base, priority``. A document also has one row with priority -1.
    """
    table = rule_table(docs.sparkSession)
    # One broadcast row per key word: its rules are tried on the words around each place of it.
    keyed = table.groupBy("word").agg(
        F.array_sort(F.collect_list(F.struct("priority", "label", "gate", "regex", "confidence", "base"))).alias("rules"))
    met = scan_words(docs, keyed)
    left = F.greatest(F.lit(0).cast("long"), F.col("pos") - BEFORE).cast("int")

    def text(start, count):
        return ascii_lower(F.array_join(F.slice("words", start + F.col("lead") + 1, count), " "))

    before = F.when(F.col("pos") > 0, F.concat(text(left, F.col("pos").cast("int") - left), F.lit(" "))).otherwise(F.lit(""))
    after = text(F.col("pos").cast("int"),
                 F.least(F.lit(AFTER), (F.col("n_words") - F.col("pos")).cast("int") + F.lit(0)))
    is_mark = F.col("word") == SENTINEL
    near = met.select(
        "doc_id", "text_key", "n_words", is_mark.alias("mark"), left.alias("left"),
        F.when(is_mark, F.lit("")).otherwise(F.concat(before, F.lit("@"), after)).alias("near"), F.explode("rules").alias("r"))
    near = near.filter(F.col("mark") | (
        F.contains(F.concat(F.lit(" "), F.translate("near", "@", " "), F.lit(" ")),
                   F.when(F.col("r.gate") == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.col("r.gate"), F.lit(" "))))
        & F.rlike("near", "r.regex")))
    ahead = F.expr("regexp_extract(near, r.regex, 1)")
    words_ahead = F.length(ahead) - F.length(F.translate(ahead, " ", ""))
    body = F.expr("regexp_extract(near, r.regex, 2)")
    start = (F.col("left") + words_ahead).cast("long")
    length = F.length(body) - F.length(F.translate(body, " ", "")) + 1
    return near.select("doc_id", "text_key", "n_words", F.col("r.label").alias("label"), start.alias("start"),
                       (start + length).alias("end"), F.col("r.confidence").alias("confidence"),
                       F.col("r.base").alias("base"), F.col("r.priority").alias("priority"))


def outermost(found: DataFrame) -> DataFrame:
    """``found`` with ``shown``: not inside an earlier or longer detection of the same text."""
    order = Window.partitionBy("doc_id", "text_key").orderBy(
        F.col("start"), F.col("end").desc(), F.col("priority")).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when((F.col("priority") >= 0) & ~F.col("base"), F.col("end"))).over(order)
    return found.withColumn("shown", (F.col("priority") >= 0) & (reach.isNull() | (reach < F.col("end"))))


def report(docs: DataFrame) -> DataFrame:
    found = outermost(detections(docs.select("doc_id", "text")))
    base = F.col("base") & (F.col("priority") >= 0)
    return found.groupBy("doc_id", "text_key").agg(
        F.first("n_words").cast("long").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(base | F.col("shown"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(base | F.col("shown"), F.col("confidence"))), F.lit(0.0)).alias("score"),
    ).drop("text_key")
