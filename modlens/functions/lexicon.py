"""Keyword lexicon: categories of words, and the regex literals built from them.

Everything here runs on the driver and only once per plan.  What reaches the
executors is a single regex literal (or a small array/map literal), so matching
stays inside the JVM and needs neither a join nor a Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label set of the annotation scheme.
LABELS = ("toxic", "harassment", "gender_attack", "slur", "passive_toxic", "not_toxic")
TOXIC_LABELS = LABELS[:-1]

# The moderation vocabulary by category.  A deployment passes its
# own ``Lexicon``; this one is the default so that keyword flags are comparable.
CATEGORY_WORDS = {
    "general_insults": (
        "fuck you", "fuck u", "fuck off", "go fuck yourself", "fuck yourself", "braindead", "brain dead",
        "uninstall", "bot", "trash", "useless", "noob", "dogwater", "dog water", "garbage", "shitter",
        "hardstuck", "hard stuck", "washed", "plat chat", "iron brain", "boosted", "carried", "deadweight",
        "dead weight", "liability", "anchor", "baiter", "lurk andy", "0 iq", "zero iq", "smooth brain",
    ),
    "passive_toxic": (
        "ez", "ggez", "gg ez", "diff", "ratio", "cope", "skill issue", "nice try", "unlucky",
        "just uninstall", "free elo", "free game", "not even close", "too easy", "go next", "ff 15", "ff15",
        "just ff", "first time?", "try hard", "tryhard", "stay mad", "cry about it", "mad cuz bad",
        "imagine losing", "you tried", "close game btw", "wp ig", "thanks for the rr", "thanks for free rr",
        "lol nt", "good effort tho", "ggwp", "gg wp",
    ),
    "threats_escalation": (
        "kys", "kill yourself", "reported", "you're done", "ur done", "get banned", "enjoy ban",
        "enjoy the ban", "gonna get you banned", "end yourself", "neck yourself", "rope", "unalive", "go die",
        "die irl", "ddos", "swat", "dox", "doxxed", "ip grabbed", "i know where you live",
    ),
    "gender_based": (
        "get back to kitchen", "get back to the kitchen", "go back to kitchen", "go back to the kitchen",
        "girls can't play", "girls cant play", "e-girl", "egirl", "e girl", "egirl duo", "boosted by bf",
        "boosted by boyfriend", "kitchen", "make me a sandwich", "sandwich", "dishwasher", "stay in normals",
        "girl gamer", "girl moment", "she's a girl that's why", "female moment", "female brain", "wh*re",
        "sl*t",
    ),
    "regional_slang": (
        "NHK", "TMKC", "kal aana", "bhak", "mc", "bc", "bsdk", "gandu", "chutiya", "randi", "madarchod",
        "behenchod", "amk", "orospu", "bobo", "gago", "putang ina", "anjing", "kontol", "bangsat", "tolol",
    ),
    "gameplay_toxic": (
        "throwing", "thrower", "threw", "griefing", "griefer", "smurf", "smurfing", "afk loser", "afk",
        "go afk", "rage quit", "ragequit", "trolling", "troll", "soft int", "inting", "int",
        "running it down", "flash me one more time", "stop baiting", "no comms", "diff bot", "team diff",
        "jett diff", "sage diff", "support diff", "aim diff",
    ),
}
WHOLE_WORD_WORDS = {
    "hate_terms": ("cunt", "nigga", "nigger", "faggot", "retard", "spic", "chink", "kike", "coon"),
    "profanity": (
        "fuck", "fucking", "fucked", "motherfucker", "bullshit", "asshole", "bitch", "bastard", "dickhead",
        "prick", "dick", "piss", "wanker",
    ),
}
# Which categories speak for which label.
LABEL_CATEGORIES = {
    "toxic": ("general_insults", "gameplay_toxic"),
    "harassment": ("threats_escalation", "gameplay_toxic"),
    "gender_attack": ("gender_based",),
    "slur": ("regional_slang",),
    "passive_toxic": ("passive_toxic",),
    "not_toxic": (),
}
WHOLE_WORD_LABELS = {"hate_terms": ("slur",), "profanity": ("toxic", "harassment")}
# End of fixed values.

# Letters, digits and underscore in any script; used instead of ``\b``, whose
# meaning differs between regex engines.
WORD_CLASS = r"[\p{L}\p{N}_]"


@dataclass(frozen=True)
class Lexicon:
    """Words by category, plus what each category says about a label.

    ``categories`` are matched anywhere in the text, ``whole_word`` categories only
    between word boundaries (they do count as substrings in the overall flag).
    """

    categories: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: CATEGORY_WORDS)
    whole_word: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: WHOLE_WORD_WORDS)
    label_categories: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: LABEL_CATEGORIES)
    whole_word_labels: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: WHOLE_WORD_LABELS)

    def words(self, categories: Iterable[str] | None = None) -> list[str]:
        """Distinct words, sorted; ``None`` takes every category."""
        known = {**self.categories, **self.whole_word}
        chosen = list(known if categories is None else categories)
        unknown = [c for c in chosen if c not in known]
        if unknown:
            raise ValueError(f"unknown lexicon categories: {unknown}")
        return sorted({w for c in chosen for w in known[c]})

    def label_words(self, label: str) -> list[str]:
        """Lower-cased words found anywhere in a text that speak for ``label``."""
        return sorted({w.lower() for c in self.label_categories.get(label, ()) for w in self.categories[c]})

    def label_whole_words(self, label: str) -> list[str]:
        """Lower-cased words that speak for ``label`` when they stand alone."""
        owners = [c for c, labels in self.whole_word_labels.items() if label in labels]
        return sorted({w.lower() for c in owners for w in self.whole_word[c]})

    def rows(self) -> list[tuple[str, str, bool]]:
        """(keyword, category, whole_word) rows for a lexicon table."""
        plain = [(w, c, False) for c, ws in self.categories.items() for w in ws]
        return plain + [(w, c, True) for c, ws in self.whole_word.items() for w in ws]

    def extended(self, **more: Iterable[str]) -> "Lexicon":
        """A copy with extra words in existing or new anywhere-matched categories."""
        merged = {c: tuple(ws) for c, ws in self.categories.items()}
        for category, words in more.items():
            merged[category] = tuple(dict.fromkeys([*merged.get(category, ()), *words]))
        return Lexicon(merged, self.whole_word, self.label_categories, self.whole_word_labels)


DEFAULT_LEXICON = Lexicon()


def _quote(ch: str) -> str:
    return "\\" + ch if ch in r".^$*+?()[]{}|\/-" else ch


#: more alternatives than this are put into groups guarded by their first characters
GROUP_SIZE = 6


def shared_prefix_pattern(words: Iterable[str]) -> str:
    """One regex for a word list with common prefixes factored out.

    A flat ``a|b|c`` makes the matcher try every word at every position.  Factored
    by first letter, then second and so on, it gives up after one or two
    characters; a look at the next character first picks the group to try.
    Optional tails are greedy, so the longest word wins.
    """

    def grouped(options: list[tuple[str, str]]) -> str:
        if len(options) <= GROUP_SIZE:
            return "|".join(pattern for _, pattern in options)
        step = -(-len(options) // GROUP_SIZE)
        parts = [options[i : i + step] for i in range(0, len(options), step)]
        return "|".join(f"(?=[{''.join(_quote(c) for c, _ in p)}])(?:{grouped(p)})" for p in parts)

    def build(tails: list[str]) -> str:
        by_head: dict[str, list[str]] = {}
        for tail in tails:
            if tail:
                by_head.setdefault(tail[0], []).append(tail[1:])
        options = [(head, _quote(head) + build(rest)) for head, rest in sorted(by_head.items())]
        if not options:
            return ""
        if "" in tails:
            return f"(?:{grouped(options)})?"
        return options[0][1] if len(options) == 1 else f"(?:{grouped(options)})"

    return build(sorted(set(words)))


def folded(text: Column) -> Column:
    """Lower case, with the three letters that only case-insensitive matching maps to ``s`` and ``i``.

    Matching folded text against lower-case words is faster than a matcher that
    ignores case, and says the same.
    """
    for odd, plain in (("\u017f", "s"), ("\u0131", "i"), ("\u0130", "i")):
        text = F.replace(text, F.lit(odd), F.lit(plain))
    return F.lower(text)


def minimal_words(words: Iterable[str]) -> list[str]:
    """Lower-cased words without those that contain another one: the same yes/no answer, fewer tests."""
    lowered = sorted({w.lower() for w in words}, key=len)
    kept: list[str] = []
    for word in lowered:
        if not any(k in word for k in kept):
            kept.append(word)
    return kept


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True if any word occurs anywhere in the text, ignoring case; null text and an empty list give false."""
    kept = minimal_words(words)
    if not kept:
        return F.lit(False)
    return F.coalesce(folded(text).rlike(shared_prefix_pattern(kept)), F.lit(False))


def contains_any_word(text: Column, words: Iterable[str]) -> Column:
    """True if any word stands alone in the text, ignoring case."""
    lowered = sorted({w.lower() for w in words})
    if not lowered:
        return F.lit(False)
    pattern = f"(?<!{WORD_CLASS}){shared_prefix_pattern(lowered)}(?!{WORD_CLASS})"
    return F.coalesce(folded(text).rlike(pattern), F.lit(False))


def keyword_flag(text: Column, lexicon: Lexicon = DEFAULT_LEXICON, categories=None, mode: str = "substring") -> Column:
    """Keyword flag over all or some categories, as a substring or as whole words."""
    words = lexicon.words(categories)
    if mode == "substring":
        return contains_any(text, words)
    if mode == "word":
        return contains_any_word(text, words)
    raise ValueError(f"mode must be 'substring' or 'word', not {mode!r}")


def keyword_hits(text: Column, words: Iterable[str], mode: str = "substring") -> Column:
    """Distinct lower-cased words that occur in the text, as an array.

    One regex pass, overlaps included: a lookahead captures the longest word that
    starts at each position, and the shorter words starting there can only be its
    prefixes, which a small map literal adds back.  Texts without any of the words,
    usually most of them, are told by the much faster yes/no pattern first.
    """
    lowered = sorted({w.lower() for w in words})
    if not lowered:
        return F.array().cast("array<string>")
    whole = mode == "word"
    body = shared_prefix_pattern(lowered)
    ahead, behind = (f"(?!{WORD_CLASS})", f"(?<!{WORD_CLASS})") if whole else ("", "")
    found = F.array_distinct(
        F.regexp_extract_all(folded(text), F.lit(f"{behind}(?=({body}){ahead})"), F.lit(1))
    )
    implied = {}
    for word in lowered:
        inner = [
            p
            for p in lowered
            if p != word and word.startswith(p) and not (whole and re.match(r"\w", word[len(p)]))
        ]
        if inner:
            implied[word] = [word, *inner]
    if not implied:
        hits = found
    else:
        table = F.create_map(
            *[x for w, ws in implied.items() for x in (F.lit(w), F.array(*[F.lit(v) for v in ws]))]
        )
        hits = F.array_distinct(
            F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(table, w), F.array(w))))
        )
    nothing = F.array().cast("array<string>")
    return F.when(contains_any(text, lowered), F.coalesce(hits, nothing)).otherwise(nothing)
