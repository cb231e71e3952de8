"""Columns over ad copy. Keyword rules look for substrings, in the order given."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The vocabularies of the copy rules.
URGENCY = ["limited", "today", "now", "sale", "urgent", "hurry", "quick", "fast", "offer ends"]
SOCIAL_PROOF = ["reviews", "rating", "bestseller", "trusted", "loved", "customers", "verified", "#1"]
CTA_TYPES = ["shop now", "buy now", "learn more", "get started", "sign up", "download", "visit", "order"]
PREMIUM = ["premium", "luxury", "exclusive", "elite"]
SEASONS = {"holiday": ["christmas", "holiday", "xmas", "festive"], "summer": ["summer", "beach", "warm", "hot"], "back_to_school": ["back to school", "fall", "autumn"]}
CTA_PHRASES = ["shop now", "buy now", "add to cart", "learn more", "get started", "order now", "sign up", "subscribe", "try now", "claim your", "get yours", "start now", "join now", "shop today", "buy today", "click here"]
SUBCATEGORIES = {
    "protein": ["protein powder", "whey", "casein", "plant protein"],
    "creatine": ["creatine"],
    "collagen": ["collagen"],
    "probiotics": ["probiotic", "gut health"],
    "multivitamin": ["multivitamin", "multi-vitamin"],
    "omega-3": ["fish oil", "omega 3", "omega-3"],
    "magnesium": ["magnesium"],
    "weight management": ["weight loss", "fat burner", "weight management"],
    "pre-workout": ["pre workout", "pre-workout"],
    "sleep": ["melatonin", "sleep supplement", "sleep support"],
    "vitamins": ["vitamin"],
}
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}]"
PRICE = r"(?i)\$\s?[0-9]+(\.[0-9]{2})?|\b[0-9]+(\.[0-9]{2})?\s?USD\b"
LEGAL = r"(?i)terms (and|&) conditions|results may vary|individual results|fda has not evaluated|not intended to diagnose|consult (a|your) (doctor|physician)|\*see|see store for details|while supplies last"
WORD = r"[A-Za-z0-9']+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def contains_any(text: Column, terms: list[str]) -> Column:
    """True if the lower-cased text has any term anywhere, also inside words; null counts as empty."""
    low = F.lower(text_or_empty(text))
    return reduce(or_, [F.contains(low, F.lit(t)) for t in terms])


def first_match(text: Column, rules: dict[str, list[str]], otherwise: str) -> Column:
    """Name of the first rule with a term in the text."""
    out = None
    for name, terms in rules.items():
        hit = contains_any(text, terms)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def length_or_zero(text: Column) -> Column:
    return F.length(text_or_empty(text))


def urgency(text: Column) -> Column:
    return contains_any(text, URGENCY)


def social_proof(text: Column) -> Column:
    return contains_any(text, SOCIAL_PROOF)


def cta_type(text: Column) -> Column:
    """Empty means none; other text without a known phrase is 'other', white space included."""
    known = first_match(text, {t.replace(" ", "_"): [t] for t in CTA_TYPES}, "other")
    return F.when(text_or_empty(text) == "", "none").otherwise(known)


def premium_positioning(text: Column, price: Column | None = None, median_price: Column | None = None) -> Column:
    said = contains_any(text, PREMIUM)
    if price is None or median_price is None:
        return said
    dear = (price > 0) & (median_price > 0) & (price >= 1.5 * median_price)
    return said | F.coalesce(dear, F.lit(False))


def season(text: Column) -> Column:
    return first_match(text, SEASONS, "none")


def subcategory(*parts: Column) -> Column:
    return first_match(F.concat_ws(" ", *[text_or_empty(p) for p in parts]), SUBCATEGORIES, "other supplements")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0))


def syllables(word: Column) -> Column:
    """Runs of vowels, one less for a final e, at least one."""
    low = F.lower(word)
    groups = F.regexp_count(low, F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), groups - F.when(F.endswith(low, F.lit("e")), 1).otherwise(0))


def reading_grade(text: Column) -> Column:
    """Flesch-Kincaid grade, not rounded; a text without words has grade 0."""
    found = words(text)
    n = F.size(found)
    total = F.aggregate(found, F.lit(0), lambda acc, w: acc + syllables(w))
    sentences = F.greatest(F.lit(1), F.regexp_count(text_or_empty(text), F.lit("[.!?]+")))
    return F.when(n == 0, F.lit(0.0)).otherwise(0.39 * (n / sentences) + 11.8 * (total / n) - 15.59)


def copy_features(text: Column) -> dict[str, Column]:
    """Counts and flags of a whole text, by name."""
    t = text_or_empty(text)
    letters = F.regexp_count(t, F.lit(r"\p{L}"))
    return {
        "total_word_count": F.size(words(t)),
        "total_char_count": F.length(t),
        "uppercase_ratio": F.when(letters > 0, F.regexp_count(t, F.lit(r"\p{Lu}")) / letters).otherwise(F.lit(0.0)),
        "exclamation_count": F.regexp_count(t, F.lit("!")),
        "question_count": F.regexp_count(t, F.lit(r"\?")),
        "emoji_count": F.regexp_count(t, F.lit(EMOJI)),
        "cta_present": contains_any(t, CTA_PHRASES),
        "has_price": t.rlike(PRICE),
        "has_legal": t.rlike(LEGAL),
    }


def normalised(text: Column) -> Column:
    """Lower case, other than a-z and 0-9 as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(text)), "[^a-z0-9]+", " "))


def joined_ad_text(*parts: Column) -> Column:
    """Non-empty parts with ' | ' between them."""
    return F.array_join(F.filter(F.array(*[text_or_empty(p) for p in parts]), lambda p: p != ""), " | ")


def cut_at_paragraph(text: Column, most: int) -> Column:
    """Text of at most `most` characters, cut at its last blank line where there is one."""
    head = F.substring(text, 1, most)
    back = F.instr(F.reverse(head), F.lit("\n\n"))
    cut = F.when(back > 0, F.rtrim(F.substring(head, F.lit(1), F.length(head) - back - 1))).otherwise(head)
    return F.when(F.length(text) <= most, text).otherwise(cut)


def grounded_number(value: Column, text: Column) -> Column:
    """True if the number stands in the text, plain, with two decimals, with thousands commas or a decimal comma."""
    plain = F.regexp_replace(F.format_number(value, 2), ",", "")
    whole = F.regexp_replace(plain, r"\.00$", "")
    commas = F.format_number(value, 2)
    forms = [whole, plain, commas, F.regexp_replace(commas, r"\.00$", ""), F.translate(plain, ".", ",")]
    bounded = [F.regexp_like(text_or_empty(text), F.concat(F.lit(r"(?<![0-9])"), F.regexp_replace(f, r"\.", r"\\."), F.lit(r"(?![0-9])"))) for f in forms]
    return F.coalesce(reduce(or_, bounded), F.lit(False))


# Risks that a reviewer should see, and subcategories that a text may be a candidate for.
RISKS = {
    "possible_pet": r"(?i)\b(dog|cat|pet|canine|feline|puppy)\b",
    "possible_topical": r"(?i)\b(serum|cream|balm|moisturi[sz]er|face scrub|topical|wrinkle)\b",
    "possible_equipment": r"(?i)\b(shaker bottle|blenderbottle|gym equipment|weighted sled)\b",
}
CANDIDATES = {
    "collagen": r"(?i)\bcollagen\b",
    "creatine": r"(?i)\bcreatine\b",
    "magnesium": r"(?i)\bmagnesium\b",
    "melatonin_sleep": r"(?i)\b(melatonin|sleep (?:aid|support|gumm))\b",
    "multivitamin": r"(?i)\b(multivitamin|multi-vitamin)\b",
    "omega_3": r"(?i)\b(omega[- ]?3|fish oil)\b",
    "pre_workout": r"(?i)\bpre[- ]?workout\b",
    "probiotic": r"(?i)\bprobiotic\b",
    "protein": r"(?i)\b(protein powder|whey protein|plant protein)\b",
    "vitamin": r"(?i)\bvitamin(?:s| [a-z0-9]+)?\b",
    "weight_management": r"(?i)\b(weight loss|fat burn|appetite)\b",
}


def review_strata(text: Column, queries: Column, risks: dict[str, str] = RISKS, candidates: dict[str, str] = CANDIDATES) -> Column:
    """Sorted strata for manual review: the queries that found an ad, risks and candidates its text names; query:unknown if there is none."""
    t = text_or_empty(text)
    asked = F.transform(F.filter(F.coalesce(queries, F.array().cast("array<string>")), lambda q: F.coalesce(q, F.lit("")) != ""), lambda q: F.concat(F.lit("query:"), F.lower(q)))
    named = F.array(*[F.when(t.rlike(p), k) for k, p in risks.items()], *[F.when(t.rlike(p), f"candidate:{k}") for k, p in candidates.items()])
    out = F.array_sort(F.array_distinct(F.concat(asked, F.filter(named, lambda x: x.isNotNull()))))
    return F.when(F.size(out) > 0, out).otherwise(F.array(F.lit("query:unknown")))


def standardised(level: Column) -> Column:
    return F.upper(F.trim(level))


def sorted_notes(notes: Column) -> Column:
    return F.array_sort(F.array_distinct(notes))


def taxonomy_context(source: Column, subcategory: Column) -> Column:
    """Struct of subcategory and source: only a human decision vouches for a subcategory."""
    s = text_or_empty(source)
    return F.struct(F.when(s == "human_adjudication", subcategory).alias("subcategory"), s.alias("source"))
