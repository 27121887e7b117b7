"""Fixed values that results depend on. Lists are data: pass others to the functions that take them.

Names of accounts and salts that identify one site are not here: see SiteProfile.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

# --- fixed values: topics whose threads are always relevant ---
TOPIC_SLUGS = (
    "advice-for-other-women-with-heart-disease",
    "all-about-arrhythmias",
    "atrial-fibrillation",
    "caregiver-corner",
    "coronary-artery-disease",
    "emotional-and-psychological-issues",
    "endocarditis-and-other-heart-valve-problems",
    "experiences-with-alternative-treatments",
    "experiences-with-healthcare-professionals",
    "experiences-with-medical-treatments",
    "experiences-with-prescription-medicines",
    "hearttalks-keep-the-conversation-going",
    "how-heart-disease-has-changed-my-life",
    "living-with-cardiomyopathy-and-congestive-heart-failure",
    "living-with-congenital-heart-disease",
    "my-heart-disease-diagnosis-and-symptoms",
    "myocardial-infarction-heart-attack",
    "paroxysmal-supraventricular-tachycardia-psvt",
    "research-and-clinical-trials",
    "spontaneous-coronary-artery-dissection-scad",
    "understanding-microvascular-disease",
    "younger-women-with-heart-disease",
)


@dataclass(frozen=True)
class Term:
    category: str
    pattern: str
    whole_word: bool = False


def _terms(category: str, text: str) -> tuple[Term, ...]:
    """One term a line; a leading = marks a whole word."""
    lines = [x.strip() for x in text.strip().splitlines()]
    return tuple(Term(category, x.removeprefix("="), x.startswith("=")) for x in lines)


# --- fixed values: the lexicon, in the order in which alternatives are tried ---
LEXICON = (
    *_terms(
        "condition",
        """
        heart (?:disease|attack|failure|condition|problem|issue|surgery|health|murmur|rate)
        cardiac
        cardiology
        cardiologist
        cardiovascular
        myocardial infarction
        =MI
        angina
        prinzmetal
        ischemi
        atheroscleros
        atrial fibrillation
        =afib
        =a-fib
        arrhythmi
        tachycardi
        bradycardi
        =PSVT
        palpitation
        cardiomyopath
        congestive heart
        =CHF
        =HFpEF
        =HFrEF
        ejection fraction
        =EF
        coronary
        =CAD
        =SCAD
        microvascular
        =MVD
        valve
        mitral
        aortic
        tricuspid
        stenosis
        regurgitat
        endocarditis
        pericarditis
        =atrial
        congenital heart
        =LVAD
        =POTS
        dysautonomia
        """,
    ),
    *_terms(
        "procedure",
        """
        stent
        bypass
        =CABG
        angiogram
        angioplasty
        catheteriz
        =cath lab
        =TAVR
        echocardiogram
        =echo
        =EKG
        =ECG
        stress test
        pacemaker
        =ICD
        defibrillator
        ablation
        troponin
        calcium score
        """,
    ),
    *_terms(
        "medication",
        """
        beta.?blocker
        metoprolol
        toprol
        statin
        nitroglycerin
        =nitro
        plavix
        clopidogrel
        warfarin
        coumadin
        eliquis
        xarelto
        diltiazem
        amlodipine
        imdur
        ranexa
        entresto
        amiodarone
        lisinopril
        blood thinner
        calcium channel blocker
        """,
    ),
    *_terms(
        "symptom",
        """
        chest pain
        shortness of breath
        blood pressure
        """,
    ),
)

# --- fixed values: mail providers whose addresses are personal ---
PERSONAL_MAIL = (
    "gmail.com yahoo.com hotmail.com icloud.com aol.com outlook.com msn.com comcast.net me.com live.com sbcglobal.net "
    "verizon.net att.net bellsouth.net juno.com cox.net charter.net earthlink.net mac.com mail.com ymail.com "
    "rocketmail.com gmx.com protonmail.com"
).split()

# --- fixed values: text that was read in the wrong encoding, and what it was; tried in this order ---
MOJIBAKE = (
    ("â€™", "’"),
    ("â€˜", "‘"),
    ("â€œ", "“"),
    ("â€\u009d", "”"),
    ("â€”", "—"),
    ("â€“", "–"),
    ("â€¦", "…"),
    ("â€¢", "•"),
    ("Ã©", "é"),
    ("Ã¨", "è"),
    ("Ã¡", "á"),
    ("Ã¼", "ü"),
    ("Ã±", "ñ"),
    ("Ã¶", "ö"),
    ("Â©", "©"),
    ("Â®", "®"),
    ("Â°", "°"),
    ("Â½", "½"),
    ("Â£", "£"),
    ("â€", '"'),
    ("Â", ""),
)

# --- fixed values: characters folded to plain ones ---
SINGLE_QUOTES = "\u2018\u2019\u201a\u201b\u2032"
DOUBLE_QUOTES = "\u201c\u201d\u201e\u201f\u2033"
EXOTIC_SPACES = "\u00a0\u2007\u2009\u200a\u202f\u3000\t"
ZERO_WIDTH = "[\u200b-\u200d\u2060\ufeff]"
EMOJI = "[\\x{1F300}-\\x{1FAFF}\\x{1F000}-\\x{1F2FF}\\x{2600}-\\x{27BF}\\x{2B00}-\\x{2BFF}]"

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

SHORT_POST_WORDS = 20
MAX_REPLY_PAGES = 100
CORPUS_SIZE_HINT = 12_488


@dataclass(frozen=True)
class SiteProfile:
    """What belongs to one site. A corpus that continues an older one needs that one's salt and staff names."""

    group: str = "group"
    sitemap_index: str = ""
    salt: str = "corpus::"
    staff: tuple[str, ...] = ()
    topics: tuple[str, ...] = TOPIC_SLUGS
    post_containers: tuple[str, ...] = ("ins-intouch-post", "app-individual-post")
    reply_container: str = "ins-anon-reply"
    classes: dict[str, str] = field(
        default_factory=lambda: {
            "title": "pb-title",
            "topic": "pb-topic",
            "created": "pb-created-date",
            "author": "pb-author-name",
            "body": "pb-desc",
            "reply_author": "rhb-name",
            "reply_created": "rhb-stamp",
            "reply_foot": "rbw-foot",
            "reported": "number-of-replies",
        }
    )

    @classmethod
    def load(cls, path: str | Path) -> SiteProfile:
        given = json.loads(Path(path).read_text(encoding="utf-8"))
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
