"""Fixed values of the question domain, and the tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The controlled tags of each subject.
SUBJECT_TAGS = {
    "physics": [
        "kinematics", "newtons-laws", "friction", "work-energy-power", "rotational-motion", "gravitation", "fluid-mechanics",
        "properties-of-matter", "thermal-physics", "thermodynamics", "kinetic-theory", "oscillations", "waves", "electrostatics",
        "capacitance", "current-electricity", "magnetic-effects", "electromagnetic-induction", "alternating-current",
        "electromagnetic-waves", "ray-optics", "wave-optics", "modern-physics", "atoms", "nuclei", "semiconductors",
        "communication-systems", "experimental-physics", "units-and-dimensions", "vectors", "error-analysis", "measurement",
    ],
    "chemistry": [
        "mole-concept", "atomic-structure", "periodic-classification", "chemical-bonding", "states-of-matter",
        "chemical-thermodynamics", "equilibrium", "redox-reactions", "hydrogen", "s-block", "p-block", "organic-chemistry",
        "hydrocarbons", "environmental-chemistry", "solid-state", "solutions", "electrochemistry", "chemical-kinetics",
        "surface-chemistry", "metallurgy", "d-block", "coordination-compounds", "halogen-derivatives", "alcohols-phenols-ethers",
        "aldehydes-ketones", "carboxylic-acids", "amines", "biomolecules", "polymers", "chemistry-in-everyday-life",
        "analytical-chemistry", "nuclear-chemistry", "green-chemistry",
    ],
    "mathematics": [
        "sets", "relations-and-functions", "trigonometry", "inverse-trigonometry", "matrices", "determinants",
        "continuity-and-differentiability", "application-of-derivatives", "integrals", "application-of-integrals",
        "differential-equations", "vector-algebra", "three-d-geometry", "linear-programming", "probability", "binomial-theorem",
        "sequences-and-series", "complex-numbers", "quadratic-equations", "permutations-and-combinations", "statistics",
        "mathematical-reasoning", "limits", "number-theory", "graph-theory", "inequalities", "logarithms", "modulus-function",
        "greatest-integer-function",
    ],
    "biology": [
        "diversity-in-living-world", "plant-kingdom", "animal-kingdom", "morphology-of-flowering-plants",
        "anatomy-of-flowering-plants", "cell-biology", "biomolecules-biology", "plant-physiology", "human-physiology",
        "reproduction", "genetics", "evolution", "human-health-and-disease", "biotechnology", "ecology", "microbiology",
        "immunology", "bioinformatics",
    ],
}

# The published topic aliases and their canonical topics; the order is that of precedence.
TOPIC_ALIASES = {
    "kinematics": "kinematics",
    "motion": "kinematics",
    "motion in 1d": "kinematics",
    "motion in 1-d": "kinematics",
    "motion in straight line": "kinematics",
    "motion along straight line": "kinematics",
    "rectilinear motion": "kinematics",
    "newtons laws": "newtons-laws",
    "newton laws": "newtons-laws",
    "newtons law": "newtons-laws",
    "newton law": "newtons-laws",
    "nlm": "newtons-laws",
    "laws of motion": "newtons-laws",
    "law of motion": "newtons-laws",
    "friction": "friction",
    "work energy power": "work-energy-power",
    "work energy": "work-energy-power",
    "work power energy": "work-energy-power",
    "work, energy and power": "work-energy-power",
    "rotational motion": "rotational-motion",
    "rigid body dynamics": "rotational-motion",
    "rotation": "rotational-motion",
    "system of particles": "rotational-motion",
    "system of particles and rotational motion": "rotational-motion",
    "gravitation": "gravitation",
    "gravity": "gravitation",
    "fluid mechanics": "fluid-mechanics",
    "fluids": "fluid-mechanics",
    "mechanical properties of fluids": "fluid-mechanics",
    "properties of matter": "properties-of-matter",
    "elasticity": "properties-of-matter",
    "thermal physics": "thermal-physics",
    "thermodynamics": "thermodynamics",
    "heat": "thermodynamics",
    "thermo": "thermodynamics",
    "kinetic theory": "kinetic-theory",
    "kinetic theory of gases": "kinetic-theory",
    "ktg": "kinetic-theory",
    "oscillations": "oscillations",
    "shm": "oscillations",
    "simple harmonic motion": "oscillations",
    "waves": "waves",
    "wave motion": "waves",
    "electrostatics": "electrostatics",
    "electrostatic": "electrostatics",
    "electric charges and fields": "electrostatics",
    "capacitance": "capacitance",
    "capacitors": "capacitance",
    "current electricity": "current-electricity",
    "electric current": "current-electricity",
    "magnetic effects": "magnetic-effects",
    "magnetism": "magnetic-effects",
    "moving charges and magnetism": "magnetic-effects",
    "magnetic effect of current": "magnetic-effects",
    "electromagnetic induction": "electromagnetic-induction",
    "emi": "electromagnetic-induction",
    "induction": "electromagnetic-induction",
    "alternating current": "alternating-current",
    "ac": "alternating-current",
    "electromagnetic waves": "electromagnetic-waves",
    "em waves": "electromagnetic-waves",
    "emw": "electromagnetic-waves",
    "ray optics": "ray-optics",
    "geometrical optics": "ray-optics",
    "reflection": "ray-optics",
    "refraction": "ray-optics",
    "wave optics": "wave-optics",
    "physical optics": "wave-optics",
    "interference": "wave-optics",
    "diffraction": "wave-optics",
    "polarisation": "wave-optics",
    "polarization": "wave-optics",
    "modern physics": "modern-physics",
    "dual nature": "modern-physics",
    "dual nature of matter": "modern-physics",
    "photoelectric effect": "modern-physics",
    "photoelectric": "modern-physics",
    "atoms": "atoms",
    "atomic physics": "atoms",
    "nuclei": "nuclei",
    "nuclear physics": "nuclei",
    "radioactivity": "nuclei",
    "semiconductors": "semiconductors",
    "semiconductor devices": "semiconductors",
    "logic gates": "semiconductors",
    "electronic devices": "semiconductors",
    "communication": "communication-systems",
    "communication systems": "communication-systems",
    "mole concept": "mole-concept",
    "stoichiometry": "mole-concept",
    "basic concepts": "mole-concept",
    "some basic concepts of chemistry": "mole-concept",
    "atomic structure": "atomic-structure",
    "structure of atom": "atomic-structure",
    "classification of elements": "periodic-classification",
    "periodic table": "periodic-classification",
    "periodicity": "periodic-classification",
    "chemical bonding": "chemical-bonding",
    "bonding": "chemical-bonding",
    "molecular structure": "chemical-bonding",
    "states of matter": "states-of-matter",
    "gaseous state": "states-of-matter",
    "gases": "states-of-matter",
    "thermodynamics chemistry": "chemical-thermodynamics",
    "chemical thermodynamics": "chemical-thermodynamics",
    "thermochemistry": "chemical-thermodynamics",
    "equilibrium": "equilibrium",
    "chemical equilibrium": "equilibrium",
    "ionic equilibrium": "equilibrium",
    "redox": "redox-reactions",
    "redox reactions": "redox-reactions",
    "oxidation reduction": "redox-reactions",
    "hydrogen": "hydrogen",
    "s block": "s-block",
    "s-block elements": "s-block",
    "alkali metals": "s-block",
    "alkaline earth metals": "s-block",
    "p block": "p-block",
    "p-block elements": "p-block",
    "organic chemistry": "organic-chemistry",
    "organic": "organic-chemistry",
    "hydrocarbons": "hydrocarbons",
    "alkanes": "hydrocarbons",
    "alkenes": "hydrocarbons",
    "alkynes": "hydrocarbons",
    "environmental chemistry": "environmental-chemistry",
    "solid state": "solid-state",
    "solids": "solid-state",
    "solutions": "solutions",
    "electrochemistry": "electrochemistry",
    "chemical kinetics": "chemical-kinetics",
    "kinetics": "chemical-kinetics",
    "surface chemistry": "surface-chemistry",
    "adsorption": "surface-chemistry",
    "colloids": "surface-chemistry",
    "metallurgy": "metallurgy",
    "general principles of metallurgy": "metallurgy",
    "d block": "d-block",
    "d-block elements": "d-block",
    "coordination compounds": "coordination-compounds",
    "halogen derivatives": "halogen-derivatives",
    "haloalkanes": "halogen-derivatives",
    "haloarenes": "halogen-derivatives",
    "alcohols": "alcohols-phenols-ethers",
    "phenols": "alcohols-phenols-ethers",
    "ethers": "alcohols-phenols-ethers",
    "aldehydes": "aldehydes-ketones",
    "ketones": "aldehydes-ketones",
    "carboxylic acids": "carboxylic-acids",
    "amines": "amines",
    "biomolecules": "biomolecules",
    "carbohydrates": "biomolecules",
    "proteins": "biomolecules",
    "polymers": "polymers",
    "chemistry in everyday life": "chemistry-in-everyday-life",
    "sets": "sets",
    "relations": "relations-and-functions",
    "functions": "relations-and-functions",
    "relations and functions": "relations-and-functions",
    "trigonometry": "trigonometry",
    "trigonometric functions": "trigonometry",
    "trigonometric equations": "trigonometry",
    "inverse trigonometry": "inverse-trigonometry",
    "inverse trigonometric functions": "inverse-trigonometry",
    "matrices": "matrices",
    "determinants": "determinants",
    "continuity": "continuity-and-differentiability",
    "differentiability": "continuity-and-differentiability",
    "continuity and differentiability": "continuity-and-differentiability",
    "application of derivatives": "application-of-derivatives",
    "aod": "application-of-derivatives",
    "integrals": "integrals",
    "integration": "integrals",
    "indefinite integrals": "integrals",
    "definite integrals": "integrals",
    "application of integrals": "application-of-integrals",
    "area under curve": "application-of-integrals",
    "differential equations": "differential-equations",
    "de": "differential-equations",
    "vector algebra": "vector-algebra",
    "vectors": "vector-algebra",
    "three dimensional geometry": "three-d-geometry",
    "3d geometry": "three-d-geometry",
    "linear programming": "linear-programming",
    "lp": "linear-programming",
    "probability": "probability",
    "bayes theorem": "probability",
    "binomial theorem": "binomial-theorem",
    "binomial": "binomial-theorem",
    "sequence and series": "sequences-and-series",
    "ap gp": "sequences-and-series",
    "arithmetic progression": "sequences-and-series",
    "geometric progression": "sequences-and-series",
    "complex numbers": "complex-numbers",
    "quadratic equations": "quadratic-equations",
    "permutations": "permutations-and-combinations",
    "combinations": "permutations-and-combinations",
    "permutations and combinations": "permutations-and-combinations",
    "statistics": "statistics",
    "measures of dispersion": "statistics",
    "mathematical reasoning": "mathematical-reasoning",
    "limit": "limits",
    "limits": "limits",
    "diversity in living world": "diversity-in-living-world",
    "classification": "diversity-in-living-world",
    "plant kingdom": "plant-kingdom",
    "animal kingdom": "animal-kingdom",
    "morphology of flowering plants": "morphology-of-flowering-plants",
    "anatomy of flowering plants": "anatomy-of-flowering-plants",
    "cell": "cell-biology",
    "cell biology": "cell-biology",
    "cell cycle": "cell-biology",
    "cell division": "cell-biology",
    "biomolecules biology": "biomolecules-biology",
    "enzymes": "biomolecules-biology",
    "plant physiology": "plant-physiology",
    "photosynthesis": "plant-physiology",
    "respiration in plants": "plant-physiology",
    "plant growth": "plant-physiology",
    "human physiology": "human-physiology",
    "digestion": "human-physiology",
    "circulation": "human-physiology",
    "excretion": "human-physiology",
    "locomotion": "human-physiology",
    "neural control": "human-physiology",
    "chemical coordination": "human-physiology",
    "reproduction": "reproduction",
    "reproduction in organisms": "reproduction",
    "sexual reproduction": "reproduction",
    "genetics": "genetics",
    "mendelian genetics": "genetics",
    "molecular genetics": "genetics",
    "dna": "genetics",
    "evolution": "evolution",
    "human health": "human-health-and-disease",
    "diseases": "human-health-and-disease",
    "immunity": "human-health-and-disease",
    "biotechnology": "biotechnology",
    "biotech": "biotechnology",
    "genetic engineering": "biotechnology",
    "ecology": "ecology",
    "ecosystem": "ecology",
    "biodiversity": "ecology",
    "environment": "ecology",
}

# Codes, ranks, expected sizes, domains.
SUBJECT_CODES = {"physics": "ph", "chemistry": "ch", "mathematics": "ma", "biology": "bi"}
PROVIDER_RANK = {"poolside": 7, "longcat-lite": 6, "nvidia-qwen": 5, "nvidia": 5, "zai": 4, "longcat": 4, "nvidia-mistral": 4, "longcat-chat": 3, "gemini": 2, "cerebras": 1, "vanchin": 0}
MERGE_RANK = {"nvidia": 5, "longcat": 4, "gemini": 3, "poolside": 2, "vanchin": 1, "cerebras": 0}
EXPECTED_COUNTS = {"jeemain": 90, "neet": 200, "jeeadv": 54, "ncert-exemplar": 0}
EXAM_SUBJECTS = {"jeemain": ("physics", "chemistry", "mathematics"), "neet": ("physics", "chemistry", "biology"), "jeeadv": ("physics", "chemistry", "mathematics"), "ncert-exemplar": ("physics", "chemistry", "mathematics", "biology")}
QUESTION_TYPES = ("mcq", "msq", "nat", "assertion-reason")
SOURCES = ("official-pdf", "reconstructed", "imported-kaggle", "imported-dataset")
DIFFICULTIES = ("easy", "medium", "hard")
SOLUTION_FORMATS = ("plain", "html", "markdown", "latex")
STAGES = ("ocr", "extract", "diagrams", "validate", "export")
LETTER_ANSWERS = {"a": "0", "b": "1", "c": "2", "d": "3", "e": "4"}
PLACEHOLDERS = ("[image]", "[figure]", "[diagram]", "[table]", "figure not found")

# LaTeX commands and the characters they stand for.
LATEX = {
    r"\alpha": "α",
    r"\beta": "β",
    r"\gamma": "γ",
    r"\delta": "δ",
    r"\epsilon": "ε",
    r"\zeta": "ζ",
    r"\eta": "η",
    r"\theta": "θ",
    r"\iota": "ι",
    r"\kappa": "κ",
    r"\lambda": "λ",
    r"\mu": "μ",
    r"\nu": "ν",
    r"\xi": "ξ",
    r"\omicron": "ο",
    r"\pi": "π",
    r"\rho": "ρ",
    r"\sigma": "σ",
    r"\tau": "τ",
    r"\upsilon": "υ",
    r"\phi": "φ",
    r"\chi": "χ",
    r"\psi": "ψ",
    r"\omega": "ω",
    r"\Delta": "Δ",
    r"\Theta": "Θ",
    r"\Lambda": "Λ",
    r"\Pi": "Π",
    r"\Sigma": "Σ",
    r"\Phi": "Φ",
    r"\Omega": "Ω",
    r"\rightarrow": "→",
    r"\leftarrow": "←",
    r"\Rightarrow": "⇒",
    r"\Leftarrow": "⇐",
    r"\infty": "∞",
    r"\partial": "∂",
    r"\nabla": "∇",
    r"\sqrt": "√",
    r"\int": "∫",
    r"\sum": "∑",
    r"\prod": "∏",
    r"\times": "×",
    r"\div": "÷",
    r"\pm": "±",
    r"\mp": "∓",
    r"\cdot": "·",
    r"\neq": "≠",
    r"\leq": "≤",
    r"\geq": "≥",
    r"\approx": "≈",
    r"\equiv": "≡",
    r"\propto": "∝",
    r"\emptyset": "∅",
    r"\subset": "⊂",
    r"\supset": "⊃",
    r"\subseteq": "⊆",
    r"\supseteq": "⊇",
    r"\cup": "∪",
    r"\cap": "∩",
    r"\in": "∈",
    r"\notin": "∉",
    r"\angle": "∠",
    r"\perp": "⊥",
    r"\degree": "°",
    r"\^": "^",
    r"\_": "_",
}

# What OCR gets wrong.
OCR_LITERALS = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "—": " - ", "–": "-"}

# Signs of an answer key in a text, for single documents and for several extractors.
ANSWER_KEY_PATTERNS = [
    r"(?i)answer\s*key",
    r"(?i)answer\s*:",
    r"(?i)ans\s*\.?\s*:",
    r"(?i)correct\s*answer",
    r"(?i)question\s*no",
    r"(?i)q\.?\s*no",
    r"(?i)answer\s*table",
    r"(?i)key\s*to\s*questions",
    r"(?i)solution\s*key",
    r"(?i)\[?\s*(?:ans|answer)\s*\.?\s*:\s*\]?",
    r"(?i)\[?\s*(?:ans|answer)\s*\.?\s*\]?\s*[:.\-]\s*\d+",
    r"(?i)\(?\s*(?:ans|answer)\s*\.?\s*\)?\s*[:.\-]\s*\d+",
    r"(?i)(?:\|\s*(?:q|no|question|ans|answer)\s*\|){2,}",
    r"(?i)(?:q\.?\s*(?:no)?\s*\|.*\|.*ans)",
    r"(?m)(?:^|\n)\s*\d{1,3}\s+[a-dA-D]\s*(?:\n|$)",
    r"(?i)ans\s*\.?\s*:?\s*\d+\s*\)",
    r"(?m)(?:^|\n)\s*\d{1,2}[.)]\s+[A-D]\s+\d{1,2}[.)]\s+[A-D]",
    r"\d+\s*[-–]\s*[A-Da-d]",
    r"\d+\s*\(\s*[1-4]\s*\)",
    r"(?i)\\answer\{",
    r"(?i)\\correct\b",
    r"(?i)\\key\b",
]
#: What a text in lower case must hold for each of them to match; DIGIT stands for any digit.
DIGIT = "0-9"
ANSWER_KEY_NEEDS = ["answer", "answer", "ans", "correct", "question", "q", "answer", "key", "solution", "ans", "ans", "ans", "|", "|", DIGIT, "ans", DIGIT, DIGIT, DIGIT, "\\answer{", "\\correct", "\\key"]
CONSENSUS_KEY_PATTERNS = [ANSWER_KEY_PATTERNS[k] for k in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 18)]
# The score of a page that may be an answer key.
PAGE_SIGNS = ((r"answer\s*key", 5), (r"\|\s*q\s*\|\s*ans\s*\|", 5), (r"question\s*no", 3))
PAGE_ANSWERS = (r"\d+\s*[:\-\)]\s*[1-4abcd]", r"\d+\s*\(\s*[1-4]\s*\)", r"\d+\s*[-–]\s*[a-d]")


def tag_table(spark: SparkSession) -> DataFrame:
    """(subject, tag, ord): a dimension of fixed size."""
    return spark.createDataFrame([(s, t, i) for s, tags in SUBJECT_TAGS.items() for i, t in enumerate(tags)], "subject string, tag string, ord int")


def alias_rows() -> list[tuple[str, str, int]]:
    """The published aliases, in their order."""
    return [(alias, topic, n) for n, (alias, topic) in enumerate(TOPIC_ALIASES.items())]


def alias_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(alias, canonical, ord), in order of precedence: the published table, or from a CSV file of the user's with these columns."""
    if path:
        return spark.read.schema("alias string, canonical string, ord int").option("header", True).csv(path)
    return spark.createDataFrame(alias_rows(), "alias string, canonical string, ord int")
