"""Rules are rows, not code: `rules(rule_set, label, weight, term, match_mode, fold)`.

A `RuleBook` turns the rows of one rule set into a column expression:
  substring  the padded, lower-case text contains the term, blanks included
  word       the term as a whole word or phrase, an `s` may follow the last word
  regex      a Java regular expression, case ignored
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift.functions.text import fold_text, quoted

SUBSTRING, WORD, REGEX = "substring", "word", "regex"
INLINE_TERMS = 64         # longer lists are tested as one array with early exit

RULES_SCHEMA = T.StructType([
    T.StructField("rule_set", T.StringType(), False), T.StructField("label", T.StringType()),
    T.StructField("weight", T.IntegerType()), T.StructField("term", T.StringType(), False),
    T.StructField("match_mode", T.StringType(), False), T.StructField("fold", T.BooleanType())])


@dataclass(frozen=True)
class Rule:
    rule_set: str
    term: str
    match_mode: str = SUBSTRING
    label: str | None = None
    weight: int = 0
    fold: bool = False


def java_quote(term: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", term)


class RuleBook:
    def __init__(self, rules: Iterable[Rule]):
        self.sets: dict[str, list[Rule]] = {}
        for r in rules:
            self._check(r)
            term = r.term if r.match_mode == REGEX else (fold_text(r.term) if r.fold else r.term.lower())
            if r.match_mode == WORD:
                term = term.strip()
            self.sets.setdefault(r.rule_set, []).append(
                Rule(r.rule_set, term, r.match_mode, r.label, r.weight or 0, bool(r.fold)))

    @staticmethod
    def _check(r: Rule) -> None:
        if r.match_mode not in (SUBSTRING, WORD, REGEX):
            raise ValueError(f"unknown match mode {r.match_mode!r} in rule set {r.rule_set!r}")
        if not r.term or not r.term.strip():
            raise ValueError(f"empty term in rule set {r.rule_set!r}")

    @classmethod
    def from_table(cls, rules: DataFrame) -> RuleBook:
        """Read a rules table, all of it (UDF1). Rules are written by hand; word lists made from data stay a
        table and go through `operators.joins.term_join`."""
        rows = rules.collect()
        return cls(Rule(r["rule_set"], r["term"], r["match_mode"], r["label"], r["weight"] or 0, bool(r["fold"]))
                   for r in rows)

    def rows(self) -> list[Rule]:
        return [r for rs in self.sets.values() for r in rs]

    @property
    def version(self) -> str:
        """Changes with any rule; part of the key of stored judgements."""
        text = "\n".join(sorted(f"{r.rule_set}\t{r.label}\t{r.weight}\t{r.match_mode}\t{r.fold}\t{r.term}"
                                for r in self.rows()))
        return hashlib.sha1(text.encode()).hexdigest()[:12]

    def with_set(self, name: str, rules: Sequence[Rule]) -> RuleBook:
        """A copy with one rule set replaced."""
        return RuleBook([r for r in self.rows() if r.rule_set != name] + list(rules))

    def terms(self, rule_set: str, mode: str | None = None) -> list[str]:
        return [r.term for r in self.sets.get(rule_set, []) if mode is None or r.match_mode == mode]

    def sql(self, rule_set: str, text: str) -> str:
        """FLT1, FLT3, FLT6, FLT8 as SQL text: does any rule of the set match?

        `text` is a column or SQL expression holding the padded lower-case text. An unknown or
        empty rule set never matches.
        """
        return any_sql(self.sets.get(rule_set, []), text)

    def hit(self, rule_set: str, text: str) -> Column:
        return F.expr(self.sql(rule_set, text))

    def found_sql(self, rule_set: str, text: str) -> str:
        subs = list(dict.fromkeys(self.terms(rule_set, SUBSTRING)))
        terms = ", ".join(quoted(t) for t in subs)
        return f"filter(cast(array({terms}) AS array<string>), _term -> contains({text}, _term))"

    def found(self, rule_set: str, text: str) -> Column:
        """FLT2: the substring terms of the set that occur, in list order."""
        return F.expr(self.found_sql(rule_set, text))

    def at_least_sql(self, rule_set: str, text: str, k: int) -> str:
        """FLT4: at least `k` different terms occur."""
        return f"size({self.found_sql(rule_set, text)}) >= {k}"

    def at_least(self, rule_set: str, text: str, k: int) -> Column:
        return F.expr(self.at_least_sql(rule_set, text, k))

    def groups(self, rule_set: str) -> dict[str, tuple[int, list[Rule]]]:
        """Rules by label, in declared order, with the weight of the label."""
        out: dict[str, tuple[int, list[Rule]]] = {}
        for r in self.sets.get(rule_set, []):
            weight, members = out.setdefault(r.label or "", (r.weight, []))
            members.append(r)
        return out

    def score(self, rule_set: str, text: str) -> Column:
        """CLS13: sum of the weights of the labels with a hit, each label once."""
        parts = [f"CASE WHEN {any_sql(rs, text)} THEN {w} ELSE 0 END" for w, rs in self.groups(rule_set).values()]
        return F.expr(" + ".join(parts) or "0")

    def labels(self, rule_set: str, text: str) -> Column:
        """CLS14: the labels with a hit, in declared order."""
        parts = [f"CASE WHEN {any_sql(rs, text)} THEN {quoted(label)} END"
                 for label, (_, rs) in self.groups(rule_set).items()]
        return F.expr(f"array_compact(cast(array({', '.join(parts)}) AS array<string>))")

    def first_label(self, rule_set: str, text: str, default: str) -> Column:
        """CLS15 and FLT12: label of the first rule, in declared order, that matches."""
        steps = " ".join(f"WHEN {any_sql([r], text)} THEN {quoted(r.label or '')}" for r in self.sets.get(rule_set, []))
        return F.expr(f"CASE {steps} ELSE {quoted(default)} END") if steps else F.lit(default)


def any_sql(rules: Sequence[Rule], text: str) -> str:
    subs = list(dict.fromkeys(r.term for r in rules if r.match_mode == SUBSTRING))
    words = [r.term for r in rules if r.match_mode == WORD]
    regexes = [r.term for r in rules if r.match_mode == REGEX]
    tests: list[str] = []
    if len(subs) > INLINE_TERMS:
        tests.append(f"exists(array({', '.join(quoted(t) for t in subs)}), _term -> contains({text}, _term))")
    else:
        tests += [f"contains({text}, {quoted(t)})" for t in subs]
    if words:
        tests.append(f"{text} RLIKE {quoted(word_regex(words))}")
    if regexes:
        tests.append(f"{text} RLIKE {quoted('(?iU)' + '|'.join(f'(?:{r})' for r in regexes))}")
    return "(" + " OR ".join(tests) + ")" if tests else "false"


def word_regex(words: Sequence[str]) -> str:
    return r"(?U)\b(?:" + "|".join(java_quote(w) for w in words) + r")s?\b"
