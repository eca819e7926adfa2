"""A small rule table for the invented prose of the test tables; users supply their own."""

from __future__ import annotations

from tendersift.rules import REGEX, SUBSTRING, WORD, Rule, RuleBook

SUBSTRING_SETS: dict[str, list[str]] = {
    # engagement
    "strong": ["thanedble", "therhean", "onorea", "unglich", "éément"],
    "weak": ["attion", "ouier", "geheit", "ciónja", "hetion"],
    "b2b": ["eriner", "thndsh", "ouque", "edble"],
    "b2b_strong": ["eriner"],
    "salary": ["idiot", "clown", "loser"],
    "staff_only": [" src3 ", " src4 "],
    "end_client": [" src5 ", " src11 "],
    "career": ["thaes", "aivi", "ungein"],
    # sector
    "sector": ["thtion", "éeau", "heat", "sich"],
    "sector_generic": ["thtion", "éeau"],
    "sector_specific": ["heat", "sich"],
    "sector_negative": ["lyea", "quement"],
    "sector_strong": ["onor", "ellean"],
    "agency": [" src7 ", " src1 ", " src9 "],
    "other_sector": ["ingea", "esie"],
    # scope
    "hard_out": ["esndha", "taco"],
    "acceptance": ["thble", "oure"],
    "acceptance_ok": ["thble the", "oure an"],
    "narrow_tech": ["thinger", "uemi", "sttz"],
    "narrow_signal": ["onin", "leaux"],
    "broad_signal": ["onin", "leaux", "anea", "ster"],
    "infra": ["thouth", "llbo"],
    "certification": ["ernton", "reingtion", "eringat", "thouth", "beach", "verst", "erlytion", "erlytion of"],
    "regulatory": ["heanea", "lichlich"],
    "core": ["eron", "tion", "éti"],
    "domain_ok": ["ther", "ing ", "ung", "ment"],
    "tech_stack": ["thre", "erwh"],
    "area_out": ["onnt", "paeaux"],
    "blocked_entity": [" src13 "],
    # same item, skills, topics
    "signature": ["tion", "thre", "eron", "ther", "sich", "onin", "erth", "anst", "eriner", "attion", "leaux", "ering"],
    # notices
    "purchase": ["ther", "eau "],
    "supply": ["thing", "ouen"],
    "supply_exempt": ["thing of", "thing the"],
    "goods": ["anst", "oiment"],
    "out_phrase": ["worthless", "pathetic"],
    "ambiguous": ["onor", "ieroi"],
    "domain_strong": ["hetion", "ouque", "geheit"],
    "domain_context": ["erin", "ment"],
    "domain_out": ["rely", "auxai"],
    "recall": ["hetion", "ouque", "geheit", "onor", "thanedble", "ellean"],
    # audit
    "salary_wording": ["idiot", "clown", "loser", "thinger"],
    "freelance_wording": ["eriner", "éeau"],
    "login_phrase": ["sign in", "password", "log in"],
    "generic_document": ["anvil", "rod"],
}
FOLDED_SETS: dict[str, list[str]] = {
    "sector_list": ["erth", "onin", "rely", "anst", "heea", "eron", "reau", "cion", "pare"],
}
WORD_SETS: dict[str, list[str]] = {
    "w_purchase": ["that", "des"],
    "w_supply": ["with", "pour"],
    "w_supply_exempt": ["with the", "pour la"],
    "w_goods": ["heat", "sur"],
    "w_out_phrase": ["loser", "pathetic"],
    "w_ambiguous": ["onor", "qui"],
    "w_domain_strong": ["thing", "dans", "nicht"],
    "w_domain_context": ["from", "avec"],
    "w_domain_out": ["est", "rely", "del"],
}
REGEX_SETS: dict[str, list[str]] = {
    "contract_form": [r"\b(?:pathetic|worthless)\s", r"poste en \w+ance"],
    "reference_code": [r"\b\d{3}-\d{4}\b"],
    "sector_word": [r"\b(?:innd|sur|die|el)\b"],
    "acronym": [r"\btis\b"],
    "title_acronym": [r"\b(?:es|ti)\b"],
}
# label, weight, terms; a label counts once
SKILLS: list[tuple[str, int, list[str]]] = [
    ("framing", 3, ["hetion", "éeaument", "ungein"]), ("testing", 2, ["onorea", "ouque"]),
    ("steering", 4, ["thanedble", "geheit"]), ("reporting", 1, ["eriner"]),
    ("change", 3, ["therhean", "ciónja", "lement"]), ("tooling", 4, ["erlytion", "thndsh"]),
]
TOPICS: list[tuple[str, list[str]]] = [
    ("credit", ["attion", "ouier"]), ("markets", ["onin", "leaux"]), ("payments", ["ering", "sich"]),
    ("risk", ["anst", "cion"]), ("ledger", ["qqqq"]), ("planning", ["thre", "ungen"]),
]
WORK_MODE: list[tuple[str, str]] = [("remote", "thing the"), ("hybrid", "onin"), ("on site", "sich")]
COUNTRY: list[tuple[str, str]] = [("north", "src1"), ("south", "src2"), ("west", "src5")]


def sample_rules() -> list[Rule]:
    rows = [Rule(s, t, SUBSTRING) for s, ts in SUBSTRING_SETS.items() for t in ts]
    rows += [Rule(s, t, SUBSTRING, fold=True) for s, ts in FOLDED_SETS.items() for t in ts]
    rows += [Rule(s, t, WORD) for s, ts in WORD_SETS.items() for t in ts]
    rows += [Rule(s, t, REGEX) for s, ts in REGEX_SETS.items() for t in ts]
    rows += [Rule("skill", t, SUBSTRING, label, w) for label, w, ts in SKILLS for t in ts]
    rows += [Rule("topic", t, SUBSTRING, label) for label, ts in TOPICS for t in ts]
    rows += [Rule("work_mode", t, SUBSTRING, label) for label, t in WORK_MODE]
    rows += [Rule("country", t, SUBSTRING, label) for label, t in COUNTRY]
    return rows


def sample_book() -> RuleBook:
    return RuleBook(sample_rules())
