"""Word lists, weights and limits the scoring rules work with.

The lists are ordered and the order is part of the result (first match wins, ties keep list order). Every
list can be replaced: build a ``Lexicon`` with other values and pass it to the functions that take ``lex``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------------------------
# The results depend on these exact words, numbers and their order.
# ---------------------------------------------------------------------------------------------------------

TYPOS = ["teh", "recieve", "acheive", "managment", "objecive", "formaing", "resposible", "seperated"]

GENERAL_KEYWORDS = [
    "communication", "problem solving", "technical", "leadership", "python", "sql", "flask", "data analysis",
    "teamwork", "project", "documentation", "presentation", "analytics", "stakeholders", "roadmap", "testing",
    "bug", "portfolio", "linkedin",
]

ACTION_VERBS = [
    "achieved", "analyzed", "automated", "built", "created", "delivered", "designed", "developed", "improved",
    "increased", "launched", "led", "managed", "optimized", "reduced", "shipped", "streamlined",
]

IMPACT_VERBS = [
    "managed", "led", "developed", "implemented", "engineered", "designed", "built", "achieved", "improved",
    "created",
]

WEAK_VERBS = ["helped", "worked on", "responsible for", "handled", "assisted", "participated"]

REPLACED_PHRASES = ["helped", "assisted", "worked on", "responsible for", "handled", "participated in"]

SKILLS = {
    "python": ["python", "py"],
    "sql": ["sql", "mysql", "postgresql", "postgres", "sqlite", "database"],
    "pandas": ["pandas", "dataframe", "dataframes"],
    "excel": ["excel", "spreadsheets", "vlookup", "pivot table"],
    "data visualization": ["data visualization", "tableau", "power bi", "matplotlib", "seaborn", "dashboard"],
    "machine learning": [
        "machine learning", "ml", "machine-learning", "scikit-learn", "sklearn", "modeling", "predictive",
    ],
    "nlp": ["nlp", "natural language processing", "spacy", "bert", "transformers"],
    "flask": ["flask", "web api", "rest api", "rest apis"],
    "javascript": ["javascript", "js", "typescript", "react", "node"],
    "api development": ["api", "apis", "rest api", "rest apis", "endpoint", "endpoints"],
    "git": ["git", "github", "version control"],
    "html": ["html", "html5"],
    "css": ["css", "css3", "responsive design", "responsive"],
    "communication": ["communication", "presentation", "stakeholder", "stakeholders", "collaboration"],
    "leadership": ["leadership", "led", "managed", "mentored", "ownership"],
    "testing": ["testing", "pytest", "unit test", "qa", "automation"],
}

TECH_SKILLS = [
    "python", "sql", "pandas", "excel", "flask", "data visualization", "javascript", "machine learning", "nlp",
    "testing", "api development", "git", "html", "css",
]

SOFT_SKILLS = [
    "communication", "teamwork", "problem solving", "leadership", "adaptability", "collaboration",
    "organization",
]

ROLE_HINTS = {
    "full stack developer": [
        "javascript", "react", "node", "python", "flask", "sql", "git", "testing", "api", "html", "css",
    ],
    "frontend developer": ["javascript", "react", "typescript", "html", "css", "testing", "git"],
    "front end developer": ["javascript", "react", "typescript", "html", "css", "testing", "git"],
    "backend developer": ["python", "flask", "sql", "api", "testing", "git"],
    "back end developer": ["python", "flask", "sql", "api", "testing", "git"],
    "software engineer": ["python", "javascript", "sql", "git", "testing", "code review", "api"],
    "web developer": ["javascript", "html", "css", "react", "api", "git", "testing"],
    "data analyst": ["python", "sql", "excel", "data visualization", "analytics", "reporting"],
}

LOW_SIGNAL_WORDS = [
    "role", "job", "candidate", "skills", "skill", "developer", "engineer", "full", "stack", "front",
    "frontend", "backend", "back", "end", "web", "software", "senior", "junior", "lead", "manager",
    "specialist", "analyst",
]

STOP_WORDS = [
    "and", "the", "for", "with", "from", "that", "this", "into", "your", "you", "are", "will", "have", "has",
    "our", "resume", "experience", "work",
]

EDUCATION_WORDS = ["bachelor", "master", "phd", "degree", "university", "college", "diploma"]
DEGREE_WORDS = ["bachelor", "master", "phd", "university", "college", "degree", "graduat"]
DEGREE_REASON_WORDS = DEGREE_WORDS + ["diploma"]
GPA_VALUES = ["3.5", "3.6", "3.7", "3.8", "4.0"]

PROFILE_LINKS = ["linkedin.com", "portfolio", "github.com"]
SUMMARY_MARKERS = [
    "summary", "objective", "experience", "achievements", "years of experience", "result-oriented",
]
SUMMARY_REASON_MARKERS = ["summary", "objective", "achievements", "years of experience", "result-oriented"]

WORK_CONTEXT_WORDS = [
    "experience", "employment", "work", "intern", "internship", "company", "developer", "engineer", "analyst",
    "manager", "assistant", "executive", "consultant", "specialist",
]

REQUIREMENT_PHRASES = ["required", "must have", "proficient in", "experience with", "responsible for"]

# Criterion key, label, default weight. A "{system}" in a label or sentence is filled from Lexicon.system.
CRITERIA = [
    ("contact", "Contact Information", 0.08),
    ("summary", "Professional Summary", 0.10),
    ("experience", "Work Experience", 0.18),
    ("education", "Education", 0.10),
    ("skills", "Skills", 0.20),
    ("keywords", "{system} Optimization", 0.14),
    ("consistency", "Consistency", 0.07),
    ("proofreading", "Proofreading", 0.06),
    ("file_format", "File Format", 0.04),
    ("relevance", "Relevance", 0.03),
]

ROLE_WEIGHTS = {
    "data analyst": {"skills": 0.28, "relevance": 0.08, "experience": 0.16, "education": 0.08},
    "software engineer": {"skills": 0.26, "experience": 0.22, "keywords": 0.12, "relevance": 0.06},
    "developer": {"skills": 0.28, "experience": 0.22, "keywords": 0.12, "relevance": 0.06},
    "product manager": {"summary": 0.14, "experience": 0.22, "skills": 0.16, "relevance": 0.08},
    "technical writer": {"summary": 0.16, "proofreading": 0.12, "keywords": 0.12, "relevance": 0.08},
}

DEFAULT_ROLES = [
    (
        "Data Analyst",
        "python, sql, pandas, data visualization, problem solving, communication, reporting",
        "Analyze datasets, create dashboards, and deliver insights to business stakeholders.",
    ),
    (
        "Software Engineer",
        "python, javascript, flask, sql, git, testing, agile, code review",
        "Design and implement applications, maintain code quality, and collaborate on engineering teams.",
    ),
    (
        "Product Manager",
        "communication, roadmap, stakeholders, analytics, strategy, prioritization",
        "Define product direction, coordinate teams, and shape customer-focused roadmaps.",
    ),
    (
        "Technical Writer",
        "documentation, editing, communication, clarity, process, technical writing",
        "Produce clear technical guides, manuals, and user-facing content for engineering teams.",
    ),
    (
        "Digital Marketing Specialist",
        "seo, content, analytics, copywriting, branding, social media, campaign",
        "Create campaigns, analyze performance, and develop customer-facing digital content.",
    ),
]

ALLOWED_EXTENSIONS = ["pdf", "txt", "docx"]
MAX_FILE_BYTES = 10 * 1024 * 1024
MAX_TITLE_CHARS = 160
MAX_FIELD_CHARS = 5000
MAX_CATALOG_CHARS = 800

# ---------------------------------------------------------------------------------------------------------
# End of the fixed values.
# ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """All replaceable lists in one value. ``system`` and ``system_title`` are the words reports are signed with."""

    system: str = "ATS"
    system_title: str = "Document Scoring"
    typos: list[str] = field(default_factory=lambda: list(TYPOS))
    general_keywords: list[str] = field(default_factory=lambda: list(GENERAL_KEYWORDS))
    action_verbs: list[str] = field(default_factory=lambda: list(ACTION_VERBS))
    impact_verbs: list[str] = field(default_factory=lambda: list(IMPACT_VERBS))
    weak_verbs: list[str] = field(default_factory=lambda: list(WEAK_VERBS))
    skills: dict[str, list[str]] = field(default_factory=lambda: dict(SKILLS))
    listed_skills: list[str] = field(default_factory=lambda: TECH_SKILLS + SOFT_SKILLS)
    role_hints: dict[str, list[str]] = field(default_factory=lambda: dict(ROLE_HINTS))
    low_signal_words: list[str] = field(default_factory=lambda: list(LOW_SIGNAL_WORDS))
    stop_words: list[str] = field(default_factory=lambda: list(STOP_WORDS))
    weights: dict[str, float] = field(default_factory=lambda: {key: weight for key, _, weight in CRITERIA})
    role_weights: dict[str, dict[str, float]] = field(default_factory=lambda: dict(ROLE_WEIGHTS))

    def labels(self) -> list[str]:
        """Criterion labels in criterion order."""
        return [label.format(system=self.system) for _, label, _ in CRITERIA]

    def normalized_weights(self, role: str | None = None) -> list[float]:
        """Weights in criterion order that add up to one; ``role`` names an entry of ``role_weights``."""
        merged = {**self.weights, **(self.role_weights[role] if role else {})}
        total = 0.0
        for value in merged.values():
            total += value
        return [merged[key] / total for key, _, _ in CRITERIA]


DEFAULT = Lexicon()
CRITERION_KEYS = [key for key, _, _ in CRITERIA]
