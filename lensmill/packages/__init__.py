"""Rule packages: pattern lists written for this repository, in the shapes the engine offers."""

from __future__ import annotations

from dataclasses import replace

from lensmill.functions.rules import Any, Category, Count, Groups, Keyword, Package, Raw, Rule

DOMAINS = (("shop.", "commerce"), ("src13.example", "blocklist"), ("casino", "gambling"))

FINANCE = (r"\b(?:quarterly|annual) (?:earnings|results)\b", r"\bshare price\b", r"\bstock market\b", r"\bdividend")
MILITARY = (r"\bmilitary\b", r"\bweapons?\b", r"\bmissiles?\b", r"\btroops\b")
CRIME = (r"\bmurder", r"\barrested\b", r"\bpolice said\b", r"\bsentenced\b")
PUBLIC_GOOD = (r"\bcommunity benefit\b", r"\bnon-?profit\b", r"\bcooperative\b")
PEACE = (r"\bpeace (?:talks|agreement|process)\b", r"\bceasefire\b")
JUSTICE = (r"\brestorative justice\b", r"\bexonerated\b")
SPECULATION = (r"\bmight\b", r"\bcould\b", r"\bmay one day\b", r"\bplans to\b")
OUTCOME = (r"\bachieved\b", r"\bresulted in\b", r"\bcompleted\b", r"\breduced by\b")

UPLIFTING = Package(
    "uplifting", 7, domains=DOMAINS,
    categories=(Category("corporate_finance", FINANCE, PUBLIC_GOOD), Category("military_security", MILITARY, PEACE), Category("crime_violence", CRIME, JUSTICE)),
    after=(Rule(Count(SPECULATION, 3) & Count(OUTCOME, 0, 0), "pure_speculation"),),
)
UPLIFTING_TYPE = (
    Rule(Any(PEACE), "peace_process"),
    Rule(Any(FINANCE) & ~Any(PUBLIC_GOOD), "corporate_finance"),
    Rule(Any(MILITARY) & ~Any(PEACE), "military_security"),
    Rule(Count(SPECULATION, 2) & Count(OUTCOME, 0, 1), "speculation"),
    Rule(Raw("true"), "general"),
)
UPLIFTING_OLD = Package("uplifting", 6, domains=DOMAINS, categories=UPLIFTING.categories[:2], after=UPLIFTING.after)
UPLIFTING_LEGACY = Package("uplifting", 1, domains=(*DOMAINS, ("nasdaq", "finance"), ("army.", "military")), categories=UPLIFTING.categories[:2])
THRIVING = Package("thriving", 1, domains=DOMAINS, categories=UPLIFTING.categories, after=UPLIFTING.after)

BELONG = (r"\bneighbou?rs?\b", r"\bvolunteers?\b", r"\bcommunity\b", r"\btogether\b")
OBITUARY = (r"\bpassed away\b", r"\bobituary\b", r"\bfuneral\b", r"\bin memoriam\b")
BELONGING = Package(
    "belonging", 1, domains=DOMAINS, positive=BELONG,
    categories=(
        Category("obituary", OBITUARY, floor=Count(BELONG, 2) | (Any((r"\blegacy of\b",)) & Count(BELONG, 1))),
        Category("corporate", FINANCE, PUBLIC_GOOD, positive_at=3),
        Category("crime", CRIME, JUSTICE, positive_at=2),
        Category("self_help", (r"\bself-?help\b", r"\bproductivity hacks?\b"), positive_at=2),
        Category("real_estate", (r"\bproperty market\b", r"\bluxury homes?\b"), positive_at=3),
        Category("celebrity", (r"\bcelebrity\b", r"\bred carpet\b"), positive_at=3),
        Category("sports", (r"\bfinal score\b", r"\btransfer fee\b"), positive_at=2),
        Category("politics", (r"\belection poll", r"\bparty leader\b"), positive_at=3),
    ),
    before=(Rule(Raw("regexp_like(title, '(^|[^A-Za-z])RIP([^A-Za-z]|$)')"), "excluded_obituary"),),
)

DISCOVERY = (r"\bexcavat", r"\bancient\b", r"\bmanuscripts?\b", r"\brestor(?:ed|ation)\b")
CULTURAL = Package(
    "cultural_discovery", 5, domains=DOMAINS, min_length=None,
    categories=(
        Category("political_conflict", MILITARY, PEACE),
        Category("commercial", (r"\bauction price\b", r"\bluxury\b"), DISCOVERY),
        Category("celebrity", (r"\bcelebrity\b", r"\bred carpet\b"), (r"\bheritage\b",)),
        Category("tourism", (r"\btravel deals?\b", r"\btop 10 (?:hotels|beaches)\b"), (r"\bheritage\b",)),
    ),
)
CULTURAL_TYPE = (Rule(Count(DISCOVERY, 2), "discovery"), *(Rule(Any(c.patterns) & ~Any(c.exceptions), c.name) for c in CULTURAL.categories), Rule(Raw("true"), "general"))
CULTURAL_OLD = Package("cultural_discovery", 3, domains=DOMAINS, categories=CULTURAL.categories[:3])
#: Version 2's prefilter is version 1's.
CULTURAL_EARLY = tuple(replace(CULTURAL_OLD, version=v) for v in (1, 2))

FORESIGHT_POSITIVE = ((r"\blong-?term\b", r"\bgenerations?\b"), (r"\bscenario", r"\bforesight\b"), (r"\bprecaution", r"\bprevention\b"), (r"\binfrastructure\b", r"\binvested\b"))
FORESIGHT = Package(
    "foresight", 1, domains=DOMAINS,
    before=(Rule(Groups(FORESIGHT_POSITIVE, 3), None),),
    rules=tuple(Rule(Any(p) & ~Groups(FORESIGHT_POSITIVE, 1), f"excluded_{n}") for n, p in (("finance", FINANCE), ("crime", CRIME), ("horoscope", (r"\bhoroscope\b",)))),
)

MACRO = (r"\binflation\b", r"\binterest rates?\b", r"\bcentral bank\b", r"\bgdp\b")
FOMO = (r"\bto the moon\b", r"\bdon't miss\b")
PICKS = (r"\bstocks? to buy\b", r"\bprice target\b")
AFFILIATE = (r"\bsign up now\b", r"\bpromo code\b")
CLICKBAIT = (r"^\d+ (?:stocks|reasons)\b", r"\byou won't believe\b")
INVESTMENT = Package(
    "investment_risk", 6, validate=False,
    before=(
        Rule(Raw("source IN ('src1', 'src2')"), None),
        Rule(Any(MACRO) & ~Any(FOMO), None),
        Rule(Raw("source IN ('src17', 'src18')"), "blocked_source"),
        *(Rule(Any((p,)), f"fomo:{p[:30]}") for p in FOMO),
        *(Rule(Any((p,)) & ~Any(MACRO), f"stock_picking:{p[:30]}") for p in PICKS),
        *(Rule(Any((p,)), f"affiliate:{p[:30]}") for p in AFFILIATE),
        *(Rule(Any((p,), on="title_lower"), f"clickbait:{p[:30]}") for p in CLICKBAIT),
    ),
)
INVESTMENT_LEGACY = Package(
    "investment_risk", 4, validate=False, min_length=None,
    before=(
        Rule(Any(AFFILIATE), "affiliate"), Rule(Any(CLICKBAIT, on="title_lower"), "clickbait"), Rule(Any((r"\barxiv\b", r"\bpeer-?reviewed\b")), "academic"),
        Rule(Any(PICKS) & ~Any(MACRO), "stock_picking"), Rule(Any(FOMO), "fomo"),
    ),
)
#: Versions 2 and 3 have the flow of version 4, its academic block included.
INVESTMENT_EARLY = tuple(replace(INVESTMENT_LEGACY, version=v) for v in (2, 3))

NATURE = (r"\bforests?\b", r"\bwetlands?\b", r"\bspecies\b", r"\breefs?\b", r"\brivers?\b")
RECOVERY = (r"\brecover", r"\brestor", r"\brebound", r"\breturned\b")
DISASTER = (r"\bwildfires?\b", r"\boil spill\b", r"\bextinct")
NATURE_GATE = Package("nature_recovery", 2, before=(Rule(~Any(NATURE), "not_nature_topic"),), categories=(Category("disaster", DISASTER, RECOVERY),))
#: Stems without an end boundary, so that other languages' endings match too.
PASSTHROUGH = Package("nature_recovery", 4, positive=(r"\brecover", r"\berhol", r"\brestaur", r"\brétabli"))

GREEN = ("renewable", "solar", "wind farm", "emission", "climate", "battery")
SUSTECH = Package(
    "sustainability_technology", 3, domains=DOMAINS, override=Keyword(GREEN),
    categories=tuple(
        Category(n, p)
        for n, p in (
            ("politics", (r"\belection\b",)), ("sports", (r"\bfinal score\b",)), ("gaming", (r"\bvideo games?\b",)), ("celebrity", (r"\bcelebrity\b",)), ("crime", CRIME),
            ("finance", (r"\bstock(?! exchange)\b",)), ("military", MILITARY), ("lifestyle", (r"\brecipes?\b",)), ("real_estate", (r"\bluxury homes?\b",)),
        )
    ),
    after=(Rule(~Keyword((*GREEN, "sustainab", "energy")), "not_sustainability_topic"),),
)
SUSTECH_OLD = Package("sustainability_technology", 2, categories=SUSTECH.categories[:5], after=SUSTECH.after)

AI = (r"\bmachine learning\b", r"\blarge language model", r"\bartificial intelligence\b", r"\bai\b")
ENGINEERING = (r"\bdeploy", r"\bproduction\b", r"\bcode review\b", r"\bpipelines?\b")
RESEARCH = (r"\bstate-of-the-art\b", r"\bbenchmark", r"\barxiv\b")
AI_ENGINEERING = Package(
    "ai-engineering-practice", 2, validate=False,
    before=(
        Rule(Any((r"\bpost-?mortem\b", r"\blessons learned\b")), None), *(Rule(Keyword((d,), on="url"), f"excluded_domain_{r}") for d, r in DOMAINS),
        Rule(Any((r"\bhoroscope\b", r"\bcelebrity\b")), "irrelevant"), Rule(~Any(AI), "no_ai"), Rule(~Any(ENGINEERING), "no_engineering"), Rule(Count(RESEARCH, 2), "ml_research"),
    ),
    min_length=None,
)
AI_PRACTICE = Package(
    "ai_augmented_practice", 1, validate=False, min_length=None,
    before=(
        Rule(~Any(AI), "no_ai"), Rule(Any((r"\bwill replace\b",)) & ~Any(ENGINEERING), "speculative"), Rule(Any(FINANCE), "finance"),
        Rule(Any((r"\bannounc", r"\blaunch(?:es|ed)\b")) & ~Any(OUTCOME), "product_news"), Rule(Count(RESEARCH, 2), "research"),
    ),
)

RESPONSE = (r"\bresponse\b", r"\badapted\b", r"\brebuilt\b")
TEMPORAL = (r"\bafter the\b", r"\byears later\b", r"\bsince\b")
LEARNING = (r"\blessons\b", r"\blearned\b")
DOOM = (r"\bcollapse\b", r"\bhopeless\b", r"\bcatastroph")
ADVERSITY = (r"\bflood", r"\bcrisis\b", r"\bwar\b", r"\bdrought\b")
RESILIENCE = Package(
    "resilience", 1, validate=False, min_length=None,
    before=(
        Rule(~Any((*RESPONSE, *TEMPORAL, *LEARNING)), "no_resilience_signal"), Rule(Any(DOOM) & ~Any(RESPONSE), "doom_without_response"),
        Rule(Any((r"\bpress release\b", r"\bproud to announce\b")) & ~Any(ADVERSITY), "pr_without_adversity"),
    ),
)
VERIFIED = (r"\bindependent(?:ly)? (?:audit|verified)", r"\bmeasured\b", r"\bpeer-?reviewed\b")
GREENWASH = Package(
    "todo", 1, validate=False, min_length=None,
    categories=(
        Category("greenwashing", (r"\beco-?friendly\b", r"\bcarbon neutral\b"), VERIFIED), Category("vaporware", (r"\bbreakthrough\b", r"\brevolutionary\b"), (r"\bdeployed\b", r"\bpilot\b")),
        Category("fossil_transition", (r"\bclean coal\b", r"\bblue hydrogen\b"), VERIFIED),
    ),
)
DATA = (r"\b\d+ percent\b", r"\bcost of\b", r"\bper kwh\b", r"\bprofitab")
ECON_VIABILITY = Package(
    "sustainability_economic_viability", 1, validate=False, min_length=None,
    before=(Rule(~Keyword((*GREEN, "sustainab", "energy", "cost")), "not_relevant"), Rule(Any((r"\bmust act\b(?! now to cut costs)", r"\bwe demand\b")) & ~Any(DATA), "advocacy"), Rule(Any((r"\bopinion\b", r"\beditorial\b")), "opinion")),
)
POLICY = Package(
    "sustainability_policy_effectiveness", 2, validate=False, min_length=None,
    before=(
        Rule(~Keyword((*GREEN, "sustainab", "energy", "policy")), "not_relevant"), Rule(~Any((r"\bpolic(?:y|ies)\b", r"\bregulat", r"\bsubsid")), "not_policy"),
        Rule(Any((r"\bannounc", r"\bwe demand\b")) & ~Any((*OUTCOME, *DATA)), "announcement_only"),
    ),
)

# Signs of scraped pages that are no articles, in seven languages, and of obituaries; results must match.
STRONG_JUNK = (
    r"\benable\s+javascript\b",
    r"\bjavascript\s+is\s+(?:disabled|required|not\s+available|turned\s+off)\b",
    r"\bchecking\s+your\s+browser\b",
    r"\b(?:are\s+you\s+a\s+(?:robot|human)|verify\s+you\s+are\s+human)\b",
    r"\benable\s+cookies\s+and\s+reload\b",
    r"\bactiv(?:er|ez)\s+(?:le\s+)?javascript\b",
    r"\bjavascript\s+est\s+d[ée]sactiv[ée]\b",
    r"\b(?:bitte\s+)?aktivieren\s+sie\s+javascript\b",
    r"\bjavascript\s+ist\s+deaktiviert\b",
    r"\bactiv(?:a|e|ar)\s+(?:el\s+)?javascript\b",
    r"\bjavascript\s+est[áa]\s+desactivad[oa]\b",
    r"\babilita(?:re)?\s+(?:il\s+)?javascript\b",
    r"\bjavascript\s+[èe]\s+disabilitato\b",
    r"\bschakel\s+javascript\s+in\b",
    r"\bjavascript\s+is\s+uitgeschakeld\b",
    r"\bative\s+o\s+javascript\b",
    r"\bjavascript\s+est[áa]\s+desativad[oa]\b",
    r"\bbefore\s+you\s+continue\s+to\s+google\b",
    r"\bavant\s+d.?acc[ée]der\s+[àa]\s+google\b",
    r"\bbevor\s+sie\s+zu\s+google\s+weitergehen\b",
    r"\bantes\s+de\s+ir\s+a\s+google\b",
    r"\bprima\s+di\s+continuare\s+su\s+google\b",
    r"\bvoordat\s+u\s+verdergaat\s+naar\s+google\b",
    r"\bantes\s+de\s+(?:ir\s+para|continuar\s+no)\s+google\b",
)
WEAK_JUNK = (
    r"\bwe\s+(?:and\s+our\s+partners\s+)?use\s+cookies\b",
    r"\baccept(?:ing)?\s+(?:all\s+)?cookies\b",
    r"\bcookie\s+(?:policy|consent|preferences|settings|notice)\b",
    r"\bconsent\s+to\s+the\s+use\s+of\s+cookies\b",
    r"\bmanage\s+(?:your\s+)?(?:cookie\s+)?preferences\b",
    r"\bsubscribe\s+to\s+(?:continue|read)\b",
    r"\bsign\s+in\s+to\s+(?:continue|read)\b",
    r"\bregister\s+to\s+(?:continue|read)\b",
    r"\bthis\s+(?:content|page|article|video)\s+is\s+(?:not\s+available|unavailable)\b",
    r"\bpage\s+not\s+found\b",
    r"\b40[34]\b[^.]{0,40}\b(?:not\s+found|forbidden|error)\b",
    r"\baccess\s+denied\b",
    r"\b(?:verwenden|utilisons|usamos|utilizamos|utilizziamo|gebruiken)\s+cookies\b",
    r"\bcookie[- ]?(?:richtlinie|einstellungen|einwilligung)\b",
    r"\b(?:politique|param[èe]tres|gestion)\s+(?:des\s+)?cookies\b",
    r"\b(?:pol[íi]tica|configuraci[óo]n|preferencias)\s+de\s+cookies\b",
    r"\b(?:informativa|impostazioni|preferenze)\s+(?:sui\s+)?cookie\b",
    r"\bcookie(?:beleid|instellingen|voorkeuren)\b",
    r"\bacept(?:ar|a|e)\s+(?:todas\s+)?(?:las\s+)?cookies\b",
    r"\baccepter\s+(?:tous\s+)?les\s+cookies\b",
    r"\b(?:alle\s+)?cookies\s+akzeptieren\b",
    r"\baccetta(?:re)?\s+(?:tutti\s+)?i\s+cookie\b",
    r"\babonn(?:ez[- ]vous|er)\s+pour\s+(?:lire|continuer)\b",
    r"\bsuscr[íi]b[a-z]*\s+para\s+(?:seguir\s+)?(?:leyendo|continuar)\b",
    r"\babonnieren\s+sie[,\s]+um\s+weiterzulesen\b",
    r"\babbonati\s+per\s+(?:continuare|leggere)\b",
    r"\bseite\s+nicht\s+gefunden\b",
    r"\bpage\s+(?:introuvable|non\s+trouv[ée]e)\b",
    r"\bp[áa]gina\s+no\s+encontrada\b",
    r"\bpagina\s+non\s+trovata\b",
    r"\bpagina\s+niet\s+gevonden\b",
    r"\bp[áa]gina\s+n[ãa]o\s+encontrada\b",
)
OBIT_SIGNAL = (
    r"\b(obituary|obituaries|in memoriam)\b",
    r"\b(funeral|funeral mass|funeral service|memorial service)\b",
    r"\b(passed away|laid to rest|death notice)\b",
    r"\b(dies aged|died aged|dies at \d+|died at \d+)\b",
    r"\b(dies|died) (after|following|in|while)\b",
    r"\b(survived by|in loving memory|paying tribute|pays tribute)\b",
    r"\b(mourners?|mourning|condolences)\b",
    r"\b(procession|candlelight vigil|memorial vigil)\b",
    r"\b(rest in peace)\b",
    r"\b(killed|murdered|assassinated) in \d{4}\b",
)
#: A wide net in six languages, most stems at the beginning of a word; boundaries know all letters.
_START, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
DEATH_ADJACENT = (
    rf"(?iu)passed away|laid to rest|in memoriam|{_START}(?:di(?:ed|es){_END}|obituar|death|funeral|memorial|remembrance|tribute|mourn|eulog|condolen"
    r"|overled|overlijden|gestorven|uitvaart|verstorben|gestorben|nachruf|trauer|falleci|deceso|óbito|esquela|décès|obsèques|disparition|hommage)"
)
COMMERCE = (r"\bbuy now\b", r"\bdiscount\b", r"\bfree shipping\b", r"\bpromo code\b", r"\bbest deals?\b", r"\blimited offer\b", r"\bprime day\b", r"\bblack friday\b", r"\bunder \$\d+", r"\bon sale\b")

#: Sentences that queries put before the invented prose of the stand-in table, so that rules have something to find.
TOPICS = (
    "The company reported quarterly earnings and a higher dividend.",
    "Troops and weapons moved despite a ceasefire and peace talks.",
    "Police said a man was arrested; the murder trial might start, could fail, and plans to appeal may one day come.",
    "Neighbours and volunteers came together in the community.",
    "She passed away; the funeral drew neighbours and volunteers. Condolences.",
    "Ancient manuscripts were restored after an excavation; a celebrity bought luxury.",
    "Long-term infrastructure, foresight and prevention for generations.",
    "Inflation and interest rates rose; stocks to buy, to the moon, promo code.",
    "Forests recover as species returned to rivers.",
    "Wildfires and an oil spill hit the wetlands; some species are extinct.",
    "Solar and battery storage: a regulation reduced by 20 percent the cost of energy, completed.",
    "Machine learning in production: we deploy pipelines; lessons learned since the crisis.",
    "Eco-friendly breakthrough, carbon neutral and revolutionary, proud to announce clean coal.",
    "Please enable javascript and accept all cookies to subscribe.",
    "Buy now, best deals, free shipping under $20 in this limited offer.",
    "Artificial intelligence policy announced; we demand renewable energy, must act.",
)
#: Pages of nothing but signs, for the query of scraped junk.
JUNK_PAGES = (
    "Checking your browser before you access the site.",
    "Avant d’accéder à Google, acceptez.",
    "JavaScript è disabilitato nel tuo browser oggi.",
    "JavaScript ist deaktiviert. Bitte laden Sie neu.",
    "Seite nicht gefunden: gehen Sie zur Startseite.",
    "Página não encontrada. Política de cookies do site.",
    "We use cookies on this site; see the cookie policy for more of it.",
    "A brief of more than eight words that names the cookie policy of one site once.",
    "Ein kurzer Text ohne jedes Zeichen, der ganz in Ordnung ist.",
    "Voordat u verdergaat naar Google",
    "Kort.",
)
