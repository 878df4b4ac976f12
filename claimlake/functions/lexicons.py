"""Default lexicons. They are parameters of the operators; all of them are fixed values that results depend on."""

# Fixed values.
ABSOLUTE_MARKERS = ("always", "never", "every time", "guaranteed", "100%", "certainly", "without exception")
INFERRED_MARKERS = ("always", "never", "guaranteed", "100%", "every time")
AMBIGUOUS_MARKERS = (
    "looks", "feels", "seems", "appears", "might", "could be", "probably", "maybe", "sort of", "kind of",
    "looks good", "looks bad", "looks weak", "looks strong", "feels heavy", "feels light", "feels right",
)
TAUTOLOGIES = (
    ("price goes up", "price increases"), ("price goes down", "price decreases"), ("bullish", "expect bullishness"),
    ("bearish", "expect bearishness"), ("price rises", "price moves up"), ("price falls", "price moves down"),
)
CONTRADICTIONS = (("bullish", "bearish"), ("long", "short"), ("buy", "sell"), ("support", "resistance"))
NARRATIVE = (
    "I think", "this suggests", "likely", "probably", "seems to", "appears to", "in my opinion", "I believe",
    "it looks like", "might be", "could mean", "I feel",
)
IF_THEN_PATTERNS = (
    r"(?i)(?:if|when)\s+(.+?)(?:,\s*|\s+then\s+)(.+?)(?:\.|$)",
    r"(?i)(.+?)\s+(?:is your|that'?s your)\s+(.+?)(?:\.|$)",
)
#: What a text must contain for the pattern at the same place to match; the lazy groups make a search without it quadratic.
IF_THEN_GATES = (r"(?i)(?:if|when)\s", r"(?i)(?:is|thats|that's) your\s")
CATEGORIES = (
    ("MENTORSHIP", ("mentorship",)), ("LIVE_SESSION", ("live", "stream")), ("QA", ("q&a", "question")),
    ("LECTURE", ("lecture", "lesson")), ("REVIEW", ("review",)),
)

#: What a verdict says for each failure: (code, reason, citation); %s is the marker, the pair's terms, or the number of shared words.
REASONS = (
    ("provenance:source", "Missing provenance — no timestamp or source attribution", "INV-SOURCE-PROVENANCE: Every if-then traces to transcript timestamp"),
    ("provenance:timestamp", "Missing timestamp — source exists but no temporal reference", "INV-SOURCE-PROVENANCE"),
    ("falsifiability", "Unfalsifiable claim — contains absolute marker: '%s'", "Claims with absolute quantifiers cannot be empirically tested"),
    ("logical_consistency:contradiction", "Logical contradiction — action contains both buy and sell without alternative", "Mutually exclusive actions in single signature"),
    ("logical_consistency:empty", "Incomplete signature — empty condition or action", "If-then signature requires both IF and THEN clauses"),
    ("tautology:pair", "Tautology — condition '%s' restates action '%s'", "Circular logic: condition implies action by definition"),
    ("tautology:overlap", "Tautology suspected — %s words overlap between condition and action", "High word overlap suggests circular reasoning"),
    ("ambiguity:condition", "Ambiguity — condition contains subjective marker: '%s'", "Conditions must be objectively testable without interpretation"),
    ("ambiguity:action", "Ambiguity — action contains subjective marker: '%s'", "Actions must be concrete and executable"),
    ("canon_conflict", "Conflicts with canon — condition uses '%s' but the theory contains '%s' in similar context", "Theory line containing: '%s'"),
)
# Fixed values end.
