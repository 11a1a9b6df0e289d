"""Patterns of a corpus, as configuration: titles, markers, headings and phrases are the caller's."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


def any_of(words: tuple[str, ...]) -> str:
    """An expression for any of these literals; one that never matches for none."""
    return "(?:" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + ")" if words else r"(?!)"


@dataclass(frozen=True)
class Grammar:
    """What a corpus's lines look like. All fields but the literals are Java regular expressions.

    The defaults are a small neutral sample in English, for tests and examples.
    """

    #: whole lines that are page furniture, with a page number before or after or none
    running_titles: tuple[str, ...] = ("Garden handbook", "Annual edition")
    #: question marks of a record's answer fields
    judgement: str = r"\bVerdict:\s*"
    evidence: str = r"\bEvidence(?:\s+summary)?\s*[0-9,\- ]*:\s*"
    considerations: str = r"\b(?:Considerations|Notes for practice):\s*"
    lettered: str = r"^[a-z]\)\s"
    context: str = r"^Context$"
    topic_start: str = r"^Topic\s+\d+"
    sub_start: str = r"^Sub-question\s+\d+"
    umbrella_start: str = r"^Umbrella\s+\d+"
    umbrella_end: str = r"^(?:Preview ends|List of questions)\b"
    narration: str = r"question is divided into"
    #: the word that starts the narration's sentence
    narration_cut: str = r"\bquestion\b"
    intervention: str = r"^Intervention\b"
    pairs: tuple[str, ...] = ()
    label: str = r"^\d+\.\s"
    acronyms: tuple[str, ...] = ("NPK", "DNA")
    # fixed values: units and a name whose numbers are no footnotes
    units: tuple[str, ...] = ("kg/m", "mg/m", "cm/m")
    numbered: tuple[str, ...] = ("Media",)
    cross_reference: str = r"\bsee\s+(?:the\s+)?previous\s+sections?\b"
    no_evidence: tuple[str, ...] = ("No evidence", "No studies were found", "Not applicable")
    empty_considerations: tuple[str, ...] = ("None", "None.", "N/A")
    default_evidence: str = "No evidence reported."
    #: (doc_id, nth orphan context heading) to (topic, subtopic)
    orphans: tuple[tuple[str, int, str, str], ...] = ()
    #: (doc_id, literal that a line of a new section begins with)
    boundaries: tuple[tuple[str, str], ...] = ()
    labels: dict[str, dict[str, str]] = field(default_factory=lambda: {"en": {"topic": "Topic", "subtopic": "Subtopic", "question": "Question", "focus": "Focus"}})
    justification_labels: tuple[str, str] = ("Evidence", "Considerations")

    def furniture(self) -> str:
        t = any_of(self.running_titles)
        return rf"(?iu)^(?:\d+\s+{t}|{t}(?:\s+\d+)?)$"
