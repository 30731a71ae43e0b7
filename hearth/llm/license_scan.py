"""License scan: ordered signature rules with a keyword gate (native).

A rule is a regular expression over the words of a text, in lower case and with one
blank between; it is tried only at the words that are its keyword, on the words around.
Detections are intervals of words. A stronger rule's interval suppresses the weaker
ones it contains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the separators where letters still have their case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AROUND = 24  # words on either side of a keyword that a rule may read; no rule spans more

# Phrases whose every place is reported, with their labels.
BASE = [("mit", "mit @license"), ("apache", "apache @license"), ("gpl", "general public @license")]

# Licenses by label: how their names are written, as words.
NAMES = [
    ("mit", r"(?:x11 )?(?:mit|expat)(?: x11)?"),
    ("mit-0", r"mit (?:0|no attribution)"),
    ("apache-1.1", r"apache(?: software)? 1 1"),
    ("apache-2.0", r"(?:apache(?: software)?(?: license)?(?: version)? 2(?: 0)?)"),
    ("apache", r"apache(?: software(?: foundation)?)?"),
    ("gpl-1.0", r"(?:gnu )?gpl ?v?1(?: 0)?"),
    ("gpl-2.0", r"(?:gnu )?(?:gpl ?v?2(?: 0)?|general public(?: license)? version 2)"),
    ("gpl-3.0", r"(?:gnu )?(?:gpl ?v?3(?: 0)?|general public(?: license)? version 3)"),
    ("gpl", r"(?:gnu )?(?:gpl|general public)"),
    ("lgpl-2.0", r"(?:gnu )?(?:lgpl ?v?2(?: 0)?|library general public)"),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl ?v?2 1|lesser general public version 2 1)"),
    ("lgpl-3.0", r"(?:gnu )?(?:lgpl ?v?3(?: 0)?|lesser general public version 3)"),
    ("lgpl", r"(?:gnu )?(?:lgpl|lesser general public)"),
    ("agpl-3.0", r"(?:gnu )?(?:agpl ?v?3(?: 0)?|affero general public(?: version 3)?)"),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation)"),
    ("bsd-0-clause", r"(?:0bsd|bsd 0 clause|zero clause bsd)"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|bsd 2(?: clause)?|(?:2|two) clause bsd)"),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|bsd 3(?: clause)?|(?:3|three) clause bsd)"),
    ("bsd-4-clause", r"(?:original bsd|bsd 4(?: clause)?|(?:4|four) clause bsd)"),
    ("bsd", r"(?:berkeley software distribution|bsd)"),
    ("isc", r"(?:isc|internet systems consortium)"),
    ("mpl-1.1", r"(?:mpl|mozilla public)(?: version)? 1 1"),
    ("mpl-2.0", r"(?:mpl|mozilla public)(?: version)? 2(?: 0)?"),
    ("mpl", r"(?:mpl|mozilla public)"),
    ("epl-1.0", r"(?:epl|eclipse public)(?: version)? 1(?: 0)?"),
    ("epl-2.0", r"(?:epl|eclipse public)(?: version)? 2(?: 0)?"),
    ("epl", r"(?:epl|eclipse public)"),
    ("edl-1.0", r"(?:edl|eclipse distribution)"),
    ("cddl-1.0", r"(?:cddl(?: 1 0)?|common development and distribution)"),
    ("cpl-1.0", r"(?:cpl 1 0|common public)"),
    ("cpal-1.0", r"(?:cpal 1 0|common public attribution)"),
    ("eupl-1.1", r"(?:eupl|european union public)(?: version)? 1 1"),
    ("eupl-1.2", r"(?:eupl|european union public)(?: version)? 1 2"),
    ("eupl", r"(?:eupl|european union public)"),
    ("artistic-1.0", r"artistic 1(?: 0)?"),
    ("artistic-2.0", r"artistic 2(?: 0)?"),
    ("artistic", r"(?:clarified )?artistic"),
    ("zlib", r"zlib(?: libpng)?"),
    ("libpng", r"libpng"),
    ("boost-1.0", r"boost software"),
    ("unlicense", r"unlicense"),
    ("wtfpl", r"(?:wtfpl|do what the f\w* you want to public)"),
    ("cc0-1.0", r"(?:cc0(?: 1 0)?|cc zero|creative commons zero)"),
    ("cc-by-nc-nd", r"(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv\w*)(?: [1-4] 0)?"),
    ("cc-by-nc-sa", r"(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)(?: [1-4] 0)?"),
    ("cc-by-nc", r"(?:cc|creative commons) (?:by nc|attribution non ?commercial)(?: [1-4] 0)?"),
    ("cc-by-nd", r"(?:cc|creative commons) (?:by nd|attribution no ?deriv\w*)(?: [1-4] 0)?"),
    ("cc-by-sa", r"(?:cc|creative commons) (?:by sa|attribution share ?alike)(?: [1-4] 0)?"),
    ("cc-by", r"(?:cc|creative commons) (?:by|attribution)(?: [1-4] 0)?"),
    ("creative-commons", r"creative commons"),
    ("odbl-1.0", r"(?:odbl|open database|open data commons open database)"),
    ("odc-by-1.0", r"(?:odc by|open data commons attribution)"),
    ("pddl-1.0", r"(?:pddl|public domain dedication and)"),
    ("ofl-1.1", r"(?:ofl|sil open font|open font)(?: 1 1)?"),
    ("osl-3.0", r"(?:osl|open software)(?: version)?(?: 3 0)?"),
    ("afl-3.0", r"(?:afl|academic free)(?: version)?(?: 3 0)?"),
    ("ms-pl", r"(?:ms pl|microsoft public)"),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal)"),
    ("python-2.0", r"(?:psf|python software foundation|python)(?: version 2)?"),
    ("php-3.0", r"php(?: version)?(?: 3 0\w?)?"),
    ("ruby", r"ruby"),
    ("perl", r"perl(?: 5)?"),
    ("vim", r"vim"),
    ("tcl", r"tcl(?: tk)?"),
    ("postgresql", r"postgres(?:ql)?"),
    ("openssl", r"openssl(?: ssleay)?"),
    ("curl", r"curl"),
    ("ncsa", r"(?:ncsa|university of illinois ncsa)(?: open source)?"),
    ("upl-1.0", r"(?:upl|universal permissive)"),
    ("bsl-1.1", r"(?:busl|business source)(?: 1 1)?"),
    ("sspl-1.0", r"(?:sspl|server side public)(?: version 1)?"),
    ("elastic-2.0", r"elastic(?: 2 0)?"),
    ("w3c", r"(?:w3c(?: software)?)"),
    ("json", r"json"),
    ("beerware", r"beer ?ware"),
    ("lppl-1.3", r"(?:lppl|latex project public)(?: 1 3\w?)?"),
    ("ijg", r"(?:ijg|independent jpeg group)"),
    ("hpnd", r"(?:hpnd|historical permission notice and disclaimer)"),
    ("nasa-1.3", r"nasa open source"),
    ("qpl-1.0", r"(?:qpl|q public)"),
    ("sleepycat", r"sleepycat"),
    ("watcom-1.0", r"(?:sybase )?open watcom public"),
    ("openrail", r"(?:bigscience |creativeml )?open ?rail\w*(?: m)?"),
    ("llama-community", r"llama(?: [234])? community"),
]

# Ways to name a license: (priority, weight, keyword, pattern around the name). The smaller priority is the stronger.
FORMS = [
    (1, 1.0, "spdx", r"@spdx license identifier {0}"),
    (2, 0.95, "licensed", r"@licensed under(?: the)?(?: terms of(?: the)?)? {0}(?: license)?(?: version [0-9]+(?: [0-9]+)?)?"),
    (2, 0.95, "license", r"(?:released|distributed|available|provided|published|covered) under(?: the)?(?: terms of(?: the)?)? {0} @license(?: version [0-9]+(?: [0-9]+)?)?"),
    (3, 0.8, "license", r"{0} @license(?: version [0-9]+(?: [0-9]+)?)?"),
    (3, 0.8, "licence", r"{0} @licence(?: version [0-9]+(?: [0-9]+)?)?"),
]

# Notices without a license's name: (label, priority, weight, keyword, pattern).
NOTICES = [
    ("mit", 1, 1.0, "permission", r"@permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, 1.0, "permission", r"@permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 1, 1.0, "redistribution", r"@redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", 1, 1.0, "warranty", r"this software is provided as is without any express or implied @warranty"),
    ("gpl", 1, 1.0, "redistribute", r"this program is free software you can @redistribute it and or modify it"),
    ("lgpl", 1, 1.0, "redistribute", r"this library is free software you can @redistribute it and or modify it"),
    ("boost-1.0", 1, 1.0, "permission", r"@permission is hereby granted free of charge to any person or organization"),
    ("public-domain", 2, 0.9, "domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public @domain"),
    ("public-domain", 3, 0.6, "domain", r"public @domain"),
    ("proprietary", 3, 0.6, "rights", r"all @rights reserved"),
    ("proprietary", 2, 0.8, "license", r"(?:proprietary|commercial) @license"),
    ("see-license", 4, 0.4, "license", r"see (?:the )?@license(?: file)?(?: for (?:more )?details)?"),
    ("copyright", 4, 0.3, "copyright", r"@copyright(?: c)? (?:19|20)[0-9][0-9]"),
    ("copyleft", 4, 0.4, "copyleft", r"@copyleft"),
]

# One cheap look at the raw text for each: every keyword contains one of these.
GATES = ["licen", "spdx", "permission", "redistribut", "warranty", "domain", "rights", "copyright", "copyleft"]


def rules() -> list[tuple]:
    """(rule, priority, weight, keyword, label, pattern, base): every name in every form, the notices, the base phrases."""
    out = [(p, w, kw, label, form.replace("{0}", name), False) for label, name in NAMES for p, w, kw, form in FORMS]
    out += [(p, w, kw, label, pattern, False) for label, p, w, kw, pattern in NOTICES]
    out += [(9, 0.6, "license", label, pattern, True) for label, pattern in BASE]
    return [(i, *r) for i, r in enumerate(out)]


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rules(), "rule int, priority int, weight double, keyword string, label string, pattern string, base boolean")


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of the base phrases, first_word and last_word are the
    smallest and largest word (from 0) one starts at, else null. ``labels`` adds those of
    the rules whose detections no stronger interval holds; base labels always stay. The
    score is the strongest detection's weight, 0 without one. A null or empty text has no
    words and empty labels. Repeated rows get the same result each. Only ``key`` and
    ``text`` are read.

    The gate looks at raw texts; only documents that pass are split in words, and a rule
    reads only the words around its keyword. The rules are a fixed table: a proven bound
    for the broadcast."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("sum", F.xxhash64("text"))
    lowered = F.lower("text")
    gate = F.lit(False)
    for g in GATES:
        gate = gate | lowered.contains(g)
    words = F.filter(F.split(F.translate("text", UPPER, LOWER), SEPARATORS), lambda x: x != "")
    keywords = sorted({r[3] for r in rules()})
    gated = rows.where(gate).select("id", "sum", words.alias("words"))
    spots = gated.select("id", "sum", "words", F.posexplode("words").alias("at", "keyword")).where(F.col("keyword").isin(keywords))
    left = F.greatest(F.col("at") - AROUND, F.lit(0))
    around = F.concat(F.lit(" "), F.array_join(F.concat(
        F.slice("words", left + 1, F.col("at") - left), F.array(F.concat(F.lit("@"), F.col("keyword"))),
        F.slice("words", F.col("at") + 2, F.lit(AROUND))), " "), F.lit(" "))
    spots = spots.select("id", "sum", "at", left.alias("left"), "keyword", around.alias("around"))
    some = F.lit(False)  # one literal pattern for each keyword: most places match no rule
    for k in keywords:
        any_rule = "|".join(dict.fromkeys(r[5] for r in rules() if r[3] == k))
        some = some | ((F.col("keyword") == k) & F.col("around").rlike(f" (?:{any_rule}) "))
    spots = spots.where(some)
    tried = spots.join(F.broadcast(rule_table(spark)), "keyword")
    whole = F.concat(F.lit("(?s)^(.*? )("), F.col("pattern"), F.lit(") "))
    tried = tried.where(F.regexp_like("around", F.concat(F.lit(" (?:"), F.col("pattern"), F.lit(") ")))).select(
        "*", F.call_function("regexp_extract", F.col("around"), whole, F.lit(1)).alias("before"), F.call_function("regexp_extract", F.col("around"), whole, F.lit(2)).alias("match"))
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    start = (F.col("left") + blanks(F.col("before")) - 1).cast("long")
    found = tried.select("id", "sum", "rule", "priority", "weight", "label", "base", start.alias("start"),
                         (start + blanks(F.col("match"))).alias("last")).distinct()
    doc = Window.partitionBy("id", "sum")
    ahead = doc.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("id", "sum", "priority").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("id", "sum", "priority", "start")
    stronger = F.lit(False)
    for p in sorted({r[1] for r in rules()})[:-1]:
        reach = F.max(F.when(F.col("priority") == p, F.col("last"))).over(ahead)
        stronger = stronger | ((F.col("priority") > p) & F.coalesce(reach >= F.col("last"), F.lit(False)))
    stronger = (stronger | F.coalesce(F.max("last").over(before) >= F.col("last"), F.lit(False))
                | (F.max("last").over(here) > F.col("last"))
                | (F.min("rule").over(Window.partitionBy("id", "sum", "priority", "start", "last")) < F.col("rule")))
    judged = found.withColumn("kept", F.col("base") | ~stronger)
    sets = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    per = judged.groupBy("id", "sum").agg(
        F.count_distinct(F.when(F.col("base"), F.struct("label", "start"))).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        sets(F.when(F.col("base"), F.col("label"))).alias("base_labels"), sets(F.when(F.col("kept"), F.col("label"))).alias("labels"),
        F.max(F.when(F.col("kept"), F.col("weight"))).alias("score"))
    counted = rows.select(F.col("id"), F.col("sum"), F.size(F.filter(F.split("text", BETWEEN), lambda x: x != "")).cast("long").alias("n_words"))
    joined = counted.alias("d").join(per.alias("p"), F.col("d.id").eqNullSafe(F.col("p.id")) & (F.col("d.sum") == F.col("p.sum")), "left")
    return joined.select(F.col("d.id").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                         "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                         F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
