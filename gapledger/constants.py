"""Fixed values. They have to equal the published behaviour for results to agree."""

# Fixed: words ignored by the document-level index, in their natural order.
INDEX_STOPWORDS = (
    "the a an and or but in on at to for of with by "
    "is are was were be been being have has had do does "
    "did will would shall should may might must can could "
    "this that these those it its from as all any each "
    "bank banks rbi reserve india effective following"
).split()

# Fixed: domain words ignored by the chunk-level vectors, added to the English list below.
BANKING_STOPWORDS = (
    "shall may herein thereof pursuant aforesaid said "
    "such also further circular notification dated refer "
    "para clause sub ibid viz etc bank banks rbi "
    "reserve india effective following hereinafter thereto "
    "provided however notwithstanding accordance respect"
).split()

# Fixed: the default English list of Spark's StopWordsRemover (needed where no JVM runs).
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just "
    "don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd "
    "i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's "
    "where's who's why's would"
).split()

# Fixed: shortest word kept, shortest sentence dropped, width of hashed vectors.
MIN_TOKEN_LENGTH = 3
SHORT_SENTENCE = 10
HASH_FEATURES = 8192

# Fixed: how many matches each screen shows.
DEFAULT_K = 4
PANEL_K = 5
PROMPT_K = 4
CHAT_K = 3
SHORT_K = 2

# Fixed: score tiers (strictly greater than) and the floor under the best score of a bar.
RED_ABOVE = 0.3
YELLOW_ABOVE = 0.1
BAR_FLOOR = 0.001
TIER_RED = "🔴"
TIER_YELLOW = "🟡"
TIER_WHITE = "⚪"

# Fixed: lengths of labels, previews and quoted questions.
LABEL_CHARS = 55
PREVIEW_CHARS = 400
QUOTE_CHARS = 60

# Fixed: source tags of the two chunk tables.
POLICY_TAG = "internal_policy"
CIRCULAR_TAG = "rbi_circular"

# Fixed: words that grade a report section.
GRADE_CRITICAL = "CRITICAL"
GRADE_HIGH = "HIGH"
GRADE_SUBJECT = "Gap"

# Fixed: chat topics. The first whose keywords occur wins; words in one inner tuple
# must all occur.
CHAT_TOPICS = (
    ("cooling", (("cooling",), ("upi", "wait"))),
    ("kyc", (("kyc",), ("re-verify",), ("re-kyc",))),
    ("kfs", (("kfs",), ("key facts",), ("loan document",))),
    ("cyber", (("cyber",), ("incident",), ("breach",), ("hack",))),
    ("liquidity", (("lcr",), ("liquidity",))),
    ("complaint", (("complaint",), ("grievance",), ("resolve",))),
)

# Fixed: text around a quoted question when no topic is found.
CHAT_FALLBACK = (
    "Based on the bank's policy framework, your query about '{question}' relates to "
    "our internal policy documentation. Please consult the relevant section in the Master Policy "
    "Manual or contact the Compliance Help Desk (ext. 4422) for authoritative guidance."
)

# Fixed: prefix of an answer given in demo mode, by language.
DEMO_PREFIX = {
    "Hindi": (
        "**[हिंदी अनुवाद — Demo Mode]**\n"
        "कृपया ध्यान दें: पूर्ण हिंदी अनुवाद के लिए कृपया Groq या Gemini API कनेक्ट करें।\n\n**English:** "
    ),
    "Marathi": (
        "**[मराठी भाषांतर — Demo Mode]**\n"
        "पूर्ण मराठी भाषांतरासाठी कृपया Groq किंवा Gemini API जोडा.\n\n**English:** "
    ),
}
ERROR_PREFIX = "⚠️ LLM error: {error}. "

# Fixed: export layout.
EXPORT_TEMPLATE = "GAP ANALYSIS REPORT\n" + "=" * 60 + "\nCircular: {ref}\n\n{report}"

# Fixed: prompt layouts. Braced names are filled from columns.
GAP_POLICY_TEMPLATE = "\n[{id} | {section} | Score: {score}]\n{text}\n"
GAP_PROMPT_TEMPLATE = """You are a Senior Compliance Officer at an Indian Scheduled Commercial Bank.
Perform a REGULATORY GAP ANALYSIS between this RBI Circular and internal bank policies.

RBI CIRCULAR
Reference : {ref}
Subject   : {subject}
Deadline  : {deadline}
Text      : {text}

MATCHED INTERNAL POLICIES
{policies}

Respond with:
**EXECUTIVE SUMMARY** (2-3 sentences)

**GAP FINDINGS** — for each conflict:
- Internal Policy / RBI Requirement / Current Status / Gap Description / Risk Level [CRITICAL/HIGH/MEDIUM/LOW]

**MANDATORY ACTION PLAN** — ordered by risk:
- Owner / Policy to Update / Specific Change (exact wording) / Deadline / Validation Step

**COMPLIANCE TIMELINE** (3 steps: immediate → system change → board reporting)

Be precise. Cite specific numbers and timelines. Do not hedge."""
SHORT_PROMPT_TEMPLATE = (
    "Perform Gap analysis. RBI Circular: {text}. Bank Policy: {policy}. "
    "Tell me the gap and action required."
)
CHAT_PROMPT_TEMPLATE = """You are a Bank Compliance Assistant helping employees understand internal policies and RBI regulations.

RELEVANT POLICY CONTEXT:
{context}

EMPLOYEE QUESTION: {question}

Provide a clear, accurate answer citing the specific policy section. Flag any recent RBI changes that affect this policy.{language}"""
LANGUAGE_REQUEST = {
    lang: (
        f"\n\nIMPORTANT: Provide your response in {lang} (Devanagari script). Start with the {lang} "
        "response, then provide an English summary below it."
    )
    for lang in ("Hindi", "Marathi")
}
CONTEXT_TEMPLATE = "[{id} | {section}] {text}"
