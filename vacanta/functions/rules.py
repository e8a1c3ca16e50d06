"""Rule engine: ordered (label, predicate) lists turned into native column expressions.

Every rule here compiles to built-in Spark expressions (``regexp_extract_all``,
``arrays_overlap``, ``regexp_extract``, ``when`` chains), so derivations stay
inside whole-stage codegen and never leave the JVM. Word lists live in
:mod:`vacanta.functions.vocab` and can be replaced by the caller.

Word rules share one scan of the text: :func:`word_index` collects every
vocabulary word once, and :func:`has_words` on a :class:`Words` tests that small
array; on a plain column it falls back to one ``rlike`` per rule.

Regex notes: patterns carry ``(?U)`` so ``\\b``, ``\\w``, ``\\d`` and ``\\s``
follow Unicode classes, as they do for ``str`` patterns in Python. Text is
lower-cased with ``F.lower`` before matching.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V

_META = set("\\.^$|?*+()[]{}")


def escape(word: str) -> str:
    """Escape regex metacharacters of a literal word."""
    return "".join("\\" + ch if ch in _META else ch for ch in word)


def alternation(words: Sequence[str]) -> str:
    return "(?:" + "|".join(escape(w) for w in words) + ")"


def word_pattern(words: Sequence[str], left: bool = True, right: bool = True, flags: str = "U") -> str:
    """``\\b(w1|w2|...)\\b`` with Unicode classes."""
    return f"(?{flags})" + (r"\b" if left else "") + alternation(words) + (r"\b" if right else "")


def char_trie(words: Sequence[str]) -> str:
    """Alternation of ``words`` as a character trie: alternatives at a node differ in
    their first character (cheap rejection), and continuations come before the end
    of a shorter word, so the longest word at a position is tried first."""
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        branches = [escape(ch) + emit(child) for ch, child in sorted(node.items()) if ch]
        if "" in node:
            branches.append("")
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    return emit(trie)


def _is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def with_implying(words: Sequence[str], vocabulary: Sequence[str]) -> list[str]:
    """``words`` plus the longer vocabulary words that start with one of them followed
    by a non-word character (finding the longer word at a position implies the
    shorter one matches there too)."""
    extra = [v for v in vocabulary if v not in words and any(
        v.startswith(w) and len(v) > len(w) and not _is_word_char(v[len(w)]) for w in words)]
    return list(words) + extra


def word_index(low_text: Column, vocabulary: Sequence[str]) -> Column:
    """All vocabulary words found in ``low_text`` in one regex pass: a look-ahead at
    every word boundary captures the longest vocabulary word starting there (zero
    width, so words inside or overlapping other words are found at their own
    start). A place whose character begins no word is left before its boundary is tested, which costs
    more. Rules then test this small array instead of re-scanning the text."""
    words = list(dict.fromkeys(vocabulary))
    begins = "".join(c if _is_word_char(c) else "\\" + c for c in sorted({w[0] for w in words if w}))
    pattern = (f"(?U)(?=[{begins}])" if all(words) else "(?U)") + r"(?=\b(" + char_trie(words) + r")\b)"
    return F.regexp_extract_all(low_text, F.lit(pattern), F.lit(1))


class Words:
    """Word tests over one lower-cased text. With an index column (see
    :func:`word_index`), a test of words from ``vocabulary`` is an
    ``arrays_overlap`` on the index; other words fall back to a regex scan."""

    def __init__(self, low: Column, found: Column | None = None, vocabulary: Sequence[str] | None = None):
        self.low = low
        self.vocabulary = list(dict.fromkeys(vocabulary or RULE_VOCABULARY))
        self.found = found if found is not None else word_index(low, self.vocabulary)


SEP = "\u001f"


def with_words(df, low: Column, name: str = "_low", vocabulary: Sequence[str] | None = None):
    """``df`` with the lower-cased text and its word index as columns, and the
    :class:`Words` reading them (drop ``name`` and ``name + '_found'`` afterwards)."""
    vocab = list(dict.fromkeys(vocabulary or RULE_VOCABULARY))
    out = df.withColumn(name, low).withColumn(name + "_found", word_index(F.col(name), vocab))
    return out, Words(F.col(name), F.col(name + "_found"), vocab)


def _text(t) -> Column:
    return t.low if isinstance(t, Words) else t


def has_words(text, words: Sequence[str]) -> Column:
    """True when any word occurs in ``text`` between word boundaries (``text`` is a
    lower-cased Column, or a :class:`Words`)."""
    if isinstance(text, Words) and all(w in text.vocabulary for w in words):
        probe = with_implying(words, text.vocabulary)
        return F.arrays_overlap(text.found, F.array(*[F.lit(w) for w in probe]))
    return _text(text).rlike(word_pattern(words))


def label_by_rules(rules: Sequence[tuple[object, Column]], default: object = None) -> Column:
    """First matching rule wins; ``rules`` is an ordered list of (label, predicate)."""
    expr = None
    for label, pred in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(pred, value) if expr is None else expr.when(pred, value)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


# Every decimal digit beyond ASCII: the scripts' digits come in runs of ten, from zero to nine.
DIGITS = "".join(chr(c + k) for c in range(0x80, 0x10000) if unicodedata.decimal(chr(c), None) == 0 for k in range(10))


def _int_group(text: Column, pattern: str, group: int, typ: str = "int") -> Column:
    """The group as a number; decimal digits of any script count, out-of-range numbers are null."""
    found = F.translate(F.regexp_extract(text, pattern, group), DIGITS, "0123456789" * (len(DIGITS) // 10))
    return F.nullif(found, F.lit("")).try_cast(typ)


# Every word list of the silver and capture-time rules; one index serves them all.
RULE_VOCABULARY = list(dict.fromkeys(
    V.INTERNSHIP_WORDS + V.ALTERNANCE_CONTRACT_WORDS + V.CDI_WORDS + V.CDD_WORDS + V.FREELANCE_WORDS
    + V.PAID_WORDS + V.UNPAID_WORDS + V.FULL_REMOTE_WORDS + V.HYBRID_WORDS + V.REMOTE_WORDS + V.PFE_WORDS
    + V.CATEGORY_ALTERNANCE_WORDS + V.INITIATION_WORDS + V.APPLICATION_WORDS + V.INGEST_PFE_WORDS_API
    + V.INGEST_PFE_WORDS_PAGES + V.INGEST_STAGE_WORDS_API + V.INGEST_STAGE_WORDS_PAGES
    + V.INGEST_ALTERNANCE_WORDS_API + V.INGEST_ALTERNANCE_WORDS_PAGES + V.INGEST_PAID_WORDS_API
    + V.INGEST_PAID_WORDS_PAGES + V.INGEST_HYBRID_WORDS_API))


# --------------------------------------------------------------------------
# silver-layer rules
# --------------------------------------------------------------------------

def corpus(*cols: Column) -> Column:
    """Space-joined text of the given columns; nulls are skipped."""
    return F.concat_ws(" ", *cols)


#: Attributes whose rule lists take rules of one's own.
RULE_LISTS = ("contract_type", "work_mode", "internship_category", "is_remunerated")


@dataclass(frozen=True)
class OwnRule:
    """A registered rule: its label where any of ``words`` occurs, or where ``predicate`` holds: a function of
    the text's :class:`Words` that gives a Column. ``before``: the label it is tried before (None: last)."""

    attribute: str
    label: object
    words: tuple = ()
    predicate: Callable[[Words], Column] | None = None
    before: object = None

    def column(self, text) -> Column:
        hit = self.predicate(text) if self.predicate is not None else has_words(text, self.words)
        return F.coalesce(hit, F.lit(False))


@dataclass(frozen=True)
class SilverRules:
    """Word lists of the silver rules; pass a modified copy to change a rule
    (``dataclasses.replace(DEFAULT_RULES, paid=[...])``), :func:`register_rules` to add some."""

    internship: tuple = tuple(V.INTERNSHIP_WORDS)
    internship_contract: tuple = tuple(V.INTERNSHIP_CONTRACT_WORDS)
    alternance_contract: tuple = tuple(V.ALTERNANCE_CONTRACT_WORDS)
    cdi: tuple = tuple(V.CDI_WORDS)
    cdd: tuple = tuple(V.CDD_WORDS)
    freelance: tuple = tuple(V.FREELANCE_WORDS)
    paid: tuple = tuple(V.PAID_WORDS)
    unpaid: tuple = tuple(V.UNPAID_WORDS)
    full_remote: tuple = tuple(V.FULL_REMOTE_WORDS)
    hybrid: tuple = tuple(V.HYBRID_WORDS)
    remote: tuple = tuple(V.REMOTE_WORDS)
    pfe: tuple = tuple(V.PFE_WORDS)
    category_alternance: tuple = tuple(V.CATEGORY_ALTERNANCE_WORDS)
    initiation: tuple = tuple(V.INITIATION_WORDS)
    application: tuple = tuple(V.APPLICATION_WORDS)
    own: tuple[OwnRule, ...] = ()

    def vocabulary(self) -> list[str]:
        """Every word of the corpus-level lists (the contract list reads another text)."""
        out: dict[str, None] = {}
        for f in fields(self):
            if f.name not in ("internship_contract", "own"):
                for w in getattr(self, f.name):
                    out.setdefault(w, None)
        for rule in self.own:
            out |= dict.fromkeys(rule.words)
        return list(out)

    def labelled(self, attribute: str, built: Sequence[tuple[object, Column]], text) -> list[tuple[object, Column]]:
        """The attribute's built-in (label, predicate) list with the registered rules at their places."""
        out = list(built)
        for rule in self.own:
            if rule.attribute == attribute:
                at = next((k for k, (label, _) in enumerate(out) if label == rule.before), None) if rule.before is not None else len(out)
                if at is None:
                    raise ValueError(f"{attribute} has no label {rule.before!r} to stand before")
                out.insert(at, (rule.label, rule.column(text)))
        return out


DEFAULT_RULES = SilverRules()


def register_rules(attribute: str, rules: Sequence[OwnRule | tuple[object, object]], base: SilverRules = DEFAULT_RULES, before: object = None) -> SilverRules:
    """``base`` with own rules for ``attribute`` (one of ``RULE_LISTS``), tried in the given order before the label
    ``before`` (None: after the built-in ones). A rule is (label, words) or (label, function of the text's words).
    Rules are values: a job's rules are what it is given, whatever other jobs of the session register."""
    if attribute not in RULE_LISTS:
        raise ValueError(f"no rules for {attribute!r}; there are {', '.join(RULE_LISTS)}")
    made = []
    for rule in rules:
        if not isinstance(rule, OwnRule):
            label, by = rule
            rule = OwnRule(attribute, label, predicate=by, before=before) if callable(by) else OwnRule(attribute, label, tuple(by), before=before)
        if rule.predicate is None and (not rule.words or any(w != w.lower() for w in rule.words)):
            raise ValueError(f"{rule.label!r}: a rule needs lower-case words or a predicate")
        made.append(rule)
    return replace(base, own=(*base.own, *made))


def rules_table(spark, rules: SilverRules = DEFAULT_RULES):
    """The rules of the silver attributes in the order in which they are tried: (attribute, position, label,
    words, registered). Built-in rules that read other columns too (durations, the internship flag) have the words they add."""
    lists = {"contract_type": [("ALTERNANCE", rules.alternance_contract), ("STAGE", rules.internship), ("CDI", rules.cdi), ("CDD", rules.cdd), ("FREELANCE", rules.freelance)],
             "work_mode": [("FULL_REMOTE", rules.full_remote), ("HYBRID", rules.hybrid), ("REMOTE_POSSIBLE", rules.remote)],
             "internship_category": [("PFE", rules.pfe), ("ALTERNANCE", rules.category_alternance), ("STAGE_INITIATION", rules.initiation), ("STAGE_APPLICATION", rules.application), ("PFE", ())],
             "is_remunerated": [(True, rules.paid), (False, rules.unpaid)]}
    rows = []
    for attribute, built in lists.items():
        order = [(label, tuple(words), False) for label, words in built]
        for rule in rules.own:
            if rule.attribute == attribute:
                at = len(order) if rule.before is None else next(k for k, x in enumerate(order) if x[0] == rule.before)
                order.insert(at, (rule.label, rule.words, True))
        rows += [(attribute, k, str(label), list(words), own) for k, (label, words, own) in enumerate(order, 1)]
    return spark.createDataFrame(rows, "attribute string, position int, label string, words array<string>, registered boolean")


def is_internship(low_corpus: Column, low_contract: Column, rules: SilverRules = DEFAULT_RULES) -> Column:
    hit = has_words(low_corpus, rules.internship) | has_words(low_contract, rules.internship_contract)
    return F.coalesce(hit, F.lit(False))


def contract_type(low_corpus: Column, internship: Column, rules: SilverRules = DEFAULT_RULES) -> Column:
    return label_by_rules(rules.labelled("contract_type", [
        ("ALTERNANCE", has_words(low_corpus, rules.alternance_contract)),
        ("STAGE", internship),
        ("CDI", has_words(low_corpus, rules.cdi)),
        ("CDD", has_words(low_corpus, rules.cdd)),
        ("FREELANCE", has_words(low_corpus, rules.freelance)),
    ], low_corpus), "NON_SPECIFIE")


def remuneration(low_corpus: Column, paid_words=V.PAID_WORDS, unpaid_words=V.UNPAID_WORDS, rules: SilverRules = DEFAULT_RULES) -> Column:
    """Three-valued: paid words first (so "non rémunéré" is True), then unpaid words."""
    return label_by_rules(rules.labelled("is_remunerated", [
        (True, has_words(low_corpus, paid_words)),
        (False, has_words(low_corpus, unpaid_words)),
    ], low_corpus), F.lit(None).cast("boolean"))


def work_mode(low_corpus: Column, hybrid_words=V.HYBRID_WORDS, full_remote_words=V.FULL_REMOTE_WORDS,
              remote_words=V.REMOTE_WORDS, rules: SilverRules = DEFAULT_RULES) -> Column:
    return label_by_rules(rules.labelled("work_mode", [
        ("FULL_REMOTE", has_words(low_corpus, full_remote_words)),
        ("HYBRID", has_words(low_corpus, hybrid_words)),
        ("REMOTE_POSSIBLE", has_words(low_corpus, remote_words)),
    ], low_corpus), "SUR_SITE")


# FIXED VALUES. The duration patterns of the original pipeline.
WEEKS_PATTERN = r"(?U)\b(\d+)\s*" + alternation(V.WEEK_UNITS) + r"\b"
RANGE_PATTERN = r"(?U)(\d+)\s*" + alternation(V.RANGE_SEPARATORS) + r"\s*(\d+)\s*" + alternation(V.MONTH_UNITS)
SINGLE_PATTERN = r"(?U)\b([1-9]|1[0-2])\s*" + alternation(V.MONTH_UNITS) + r"\b"
DURATION_TEXT_PATTERN = r"(?U)(\d+)\s*(?:à|-)?\s*(\d+)?\s*" + alternation(V.INGEST_MONTH_UNITS)


def duration_months(low_text: Column) -> Column:
    """Months from text: weeks (``max(1, round_half_even(n/4))``), else the upper
    bound of a range, else a single 1..12 month figure, else null."""
    # the patterns cannot match without a unit; a plain substring test skips the
    # regex scans for texts without one
    has_weeks = low_text.contains("week") | low_text.contains("semaine")
    has_months = low_text.contains("mois") | low_text.contains("month")
    weeks = F.when(has_weeks, _int_group(low_text, WEEKS_PATTERN, 1, "bigint"))
    from_weeks = F.when(weeks.isNotNull(), F.greatest(F.lit(1.0), F.bround(weeks / 4, 0)).try_cast("int"))
    upper = F.when(has_months, _int_group(low_text, RANGE_PATTERN, 2))
    single = F.when(has_months, _int_group(low_text, SINGLE_PATTERN, 1))
    return F.coalesce(from_weeks, upper, single)


def duration_text(low_text: Column) -> Column:
    """First ``n [à|-] [m] mois|months`` span, verbatim, else null."""
    has_unit = low_text.contains("mois") | low_text.contains("months")
    return F.when(has_unit, F.nullif(F.regexp_extract(low_text, DURATION_TEXT_PATTERN, 0), F.lit("")))


def duration_bracket(months: Column) -> Column:
    b = V.DURATION_BRACKETS
    return label_by_rules([
        (b[0], months.isNull()),
        (b[1], months < 2),
        (b[2], months <= 3),
        (b[3], months <= 6),
    ], b[4])


def internship_category(internship: Column, months: Column, low_corpus, rules: SilverRules = DEFAULT_RULES
                        ) -> Column:
    text = low_corpus if isinstance(low_corpus, Words) else F.coalesce(low_corpus, F.lit(""))
    chain = label_by_rules(rules.labelled("internship_category", [
        ("PFE", has_words(text, rules.pfe)),
        ("ALTERNANCE", has_words(text, rules.category_alternance)),
        ("STAGE_INITIATION", F.coalesce(months == 1, F.lit(False)) | has_words(text, rules.initiation)),
        ("STAGE_APPLICATION", F.coalesce(months.isin(2, 3), F.lit(False)) | has_words(text, rules.application)),
        ("PFE", F.coalesce(months >= 4, F.lit(False))),
    ], text), "STAGE_NON_SPECIFIE")
    return F.when(F.coalesce(internship, F.lit(False)), chain)


# --------------------------------------------------------------------------
# ingest-time rules (differ by source)
# --------------------------------------------------------------------------

INGEST_PRESETS = {
    "api": dict(pfe=V.INGEST_PFE_WORDS_API, stage=V.INGEST_STAGE_WORDS_API,
                alternance=V.INGEST_ALTERNANCE_WORDS_API, paid=V.INGEST_PAID_WORDS_API,
                hybrid=V.INGEST_HYBRID_WORDS_API, contract_intern=True),
    "page_a": dict(pfe=V.INGEST_PFE_WORDS_API, stage=V.INGEST_STAGE_WORDS_PAGES,
                   alternance=V.INGEST_ALTERNANCE_WORDS_PAGES, paid=V.INGEST_PAID_WORDS_PAGES,
                   hybrid=V.HYBRID_WORDS, contract_intern=False),
    "page_b": dict(pfe=V.INGEST_PFE_WORDS_PAGES, stage=V.INGEST_STAGE_WORDS_PAGES,
                   alternance=V.INGEST_ALTERNANCE_WORDS_PAGES, paid=V.INGEST_PAID_WORDS_PAGES,
                   hybrid=V.HYBRID_WORDS, contract_intern=False),
}
INGEST_PRESETS["page_c"] = INGEST_PRESETS["page_b"]

# source name -> ingest preset
SOURCE_PRESET = {
    "adzuna_api": "api",
    "rekrute_scraper": "page_a",
    "emploima_scraper": "page_b",
    "dreamjob_scraper": "page_c",
}


def ingest_type(low_text: Column, preset: str, contract: Column | None = None) -> Column:
    p = INGEST_PRESETS[preset]
    stage = has_words(low_text, p["stage"])
    if p["contract_intern"] and contract is not None:
        stage = stage | F.coalesce(F.lower(contract).contains("intern"), F.lit(False))
    return label_by_rules([
        ("STAGE_PFE", has_words(low_text, p["pfe"])),
        ("STAGE", stage),
        ("ALTERNANCE", has_words(low_text, p["alternance"])),
    ], "CDI_OR_OTHER")


def ingest_attributes(low_text: Column, preset: str, contract: Column | None = None) -> Column:
    """The ``analytics_metadata`` struct computed when a posting is captured."""
    p = INGEST_PRESETS[preset]
    kind = ingest_type(low_text, preset, contract)
    return F.struct(
        (kind != F.lit("CDI_OR_OTHER")).alias("is_internship"),
        kind.alias("internship_type"),
        duration_text(_text(low_text)).alias("internship_duration"),
        remuneration(low_text, p["paid"], V.UNPAID_WORDS).alias("is_remunerated"),
        work_mode(low_text, p["hybrid"]).alias("work_mode"),
    )


def _chosen(low_text: Column, source: Column, field: str) -> Column:
    """Word test of ``field`` with the list of the row's source preset; presets that
    share a list share one test (keeps generated code small)."""
    groups: dict[tuple, list[str]] = {}
    for name, preset in SOURCE_PRESET.items():
        groups.setdefault(tuple(INGEST_PRESETS[preset][field]), []).append(name)
    expr = None
    for words, names in groups.items():
        value = has_words(low_text, list(words))
        expr = F.when(source.isin(*names), value) if expr is None else expr.when(source.isin(*names), value)
    return expr


def ingest_type_by_source(low_text: Column, source: Column, contract: Column | None = None) -> Column:
    api_sources = [n for n, p in SOURCE_PRESET.items() if INGEST_PRESETS[p]["contract_intern"]]
    stage = _chosen(low_text, source, "stage")
    if contract is not None and api_sources:
        stage = stage | (source.isin(*api_sources) & F.coalesce(F.lower(contract).contains("intern"), F.lit(False)))
    kind = label_by_rules([("STAGE_PFE", _chosen(low_text, source, "pfe")), ("STAGE", stage),
                           ("ALTERNANCE", _chosen(low_text, source, "alternance"))], "CDI_OR_OTHER")
    return F.when(source.isin(*SOURCE_PRESET), kind)


def ingest_internship_by_source(low_text: Column, source: Column, contract: Column | None = None) -> Column:
    return ingest_type_by_source(low_text, source, contract) != F.lit("CDI_OR_OTHER")


def ingest_attributes_by_source(low_text: Column, source: Column, contract: Column | None = None) -> Column:
    """The ``analytics_metadata`` struct with the word lists of the row's source."""
    kind = ingest_type_by_source(low_text, source, contract)
    pay = label_by_rules([(True, _chosen(low_text, source, "paid")), (False, has_words(low_text, V.UNPAID_WORDS))],
                         F.lit(None).cast("boolean"))
    mode = label_by_rules([
        ("FULL_REMOTE", has_words(low_text, V.FULL_REMOTE_WORDS)),
        ("HYBRID", _chosen(low_text, source, "hybrid")),
        ("REMOTE_POSSIBLE", has_words(low_text, V.REMOTE_WORDS)),
    ], "SUR_SITE")
    return F.struct(
        (kind != F.lit("CDI_OR_OTHER")).alias("is_internship"),
        kind.alias("internship_type"),
        duration_text(_text(low_text)).alias("internship_duration"),
        pay.alias("is_remunerated"),
        mode.alias("work_mode"),
    )


# --------------------------------------------------------------------------
# facts parsed out of free text
# --------------------------------------------------------------------------

def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def first_listed(text: Column, names: Sequence[str] = V.TEXT_CITIES, default: str = V.MOROCCO) -> Column:
    """First name of ``names`` (list order, not text order) found case-insensitively
    between word boundaries, else ``default``. One pass: the lower-cased text is
    indexed with the lower-cased names (see :func:`word_index`)."""
    lowered = [n.lower() for n in names]
    found = word_index(F.lower(text), lowered)
    hits = [F.when(F.arrays_overlap(found, F.array(*[F.lit(w) for w in with_implying([n], lowered)])), F.lit(name))
            for n, name in zip(lowered, names)]
    return F.coalesce(*hits, F.lit(default))


COMPANY_PATTERN = (r"(?iU)" + alternation(V.COMPANY_VERBS) + r"\s+(?:chez\s+)?([A-Za-z0-9\s&]+?)"
                   r"(?:" + "|".join(r"\s+" + s for s in V.COMPANY_STOPS) + r"|\s*-|\s*:|$)")


def company_from_text(text: Column, default: str = V.UNSPECIFIED) -> Column:
    """Name following a recruiting verb; kept only when 3..39 characters long."""
    name = _strip(F.regexp_extract(_strip(text), COMPANY_PATTERN, 1))
    return F.when((F.length(name) > 2) & (F.length(name) < 40), name).otherwise(F.lit(default))
