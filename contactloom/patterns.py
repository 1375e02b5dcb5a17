"""Person-mention patterns: fixed values.

Each entry is (pattern, needs). ``pattern`` is matched without regard to case and its
first group is the candidate. ``needs`` lists lower-case literals of which a matching
text must hold at least one, so a text without them skips the pattern.
"""

from __future__ import annotations

_ROLES = ("founder", "ceo", "owner", "president", "creator")
_LEADERS = ("founder", "ceo", "owner", "president", "director")

# ---------------------------------------------------------------- fixed values
# Site and card texts, in evaluation order
# -----------------------------------------------------------------------------
SITE_PATTERNS = (
    (r"(?:Verantwortliche/r|Vertreten durch|Geschäftsführer|Inhaber)[^:\n]*[:\s]+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("verantwortliche/r", "vertreten durch", "geschäftsführer", "inhaber")),
    (r"Impressum\s+(?:[A-Za-z0-9\-\.\&]+\s+)?([A-Z][a-z]+\s+[A-Z][a-z]+)", ("impressum",)),
    (r"(?:édité par|Directeur de la publication|Gérant|Fondateur)[^:\n]*[:\s]+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)",
     ("édité par", "directeur de la publication", "gérant", "fondateur")),
    (r"(?:Handelsnaam|Eigenaar|Oprichter|Contactpersoon)[^:\n]*[:\s]+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("handelsnaam", "eigenaar", "oprichter", "contactpersoon")),
    (r"(?:Fundador|Propietario|Fondatore|Proprietario)[^:\n]*[:\s]+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("fundador", "propietario", "fondatore", "proprietario")),
    (r"(?:founded|started|created|launched|established)\s+(?:officially\s+)?(?:in\s+\d{4}\s+)?by\s+(?:(?:former|famous|renowned|legendary|football|sports|fashion|celebrity|serial|tech|professional|pro|hall\s+of\s+fame|olympic|icon|entrepreneur|designer|artist|veteran|expert|enthusiast|athlete|champion|duo|team|player|longtime|childhood|lifelong|two|three|four|dutch|french|german|italian|spanish|british|american|canadian|australian|indian|japanese|chinese|korean|swedish|danish|norwegian|swiss|portuguese|irish|scottish|welsh|russian|mexican|brazilian|hamburg|berlin|munich|paris|london|vienna|zurich|rome|milan|madrid|barcelona|tokyo|toronto|montreal|sydney|melbourne)\s+)*(?:friends|partners|colleagues|brothers|sisters)?\s*([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("founded", "started", "created", "launched", "established")),
    (r"by\s+([A-Z][a-z]+)\s+and\s+([A-Z][a-z]+\s+[A-Z][a-z]+)", ("by",)),
    (r"(?:[Dd]esigned|[Cc]rafted|[Cc]urated|[Hh]andmade|[Cc]reated|[Mm]ade|[Ww]ritten|[Dd]irected|[Bb]uilt|[Oo]perated|[Oo]wned)\s+by\s+(?!hand\b|nature\b)([A-Z][a-z]+(?:\s*(?:&|and)\s*[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?)",
     ("designed", "crafted", "curated", "made", "created", "written", "directed", "built",
      "operated", "owned")),
    (r"\b[A-Za-z0-9]+\s+[Bb]y\s+([A-Z][a-z]+(?:\s*(?:&|and)\s*[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?)\s*[:\-–|]",
     ("by",)),
    (r"[-–—]\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)[,\s]+(?:Founder|Co-Founder|CEO|Owner|President|Creator)",
     _ROLES),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[-–—|,]\s*(?:(?:Small\s+)?Business\s+Owner|Store\s+Owner|Brand\s+Owner|Company\s+Owner|Owner\s+Operator|Sole\s+Proprietor|Managing\s+Partner|(?:Managing\s+)?Director|Founder\s*&?\s*(?:CEO|Owner|Creative\s+Director)?|Co-Founder|CEO|Owner|President|Creator)",
     _ROLES + ("proprietor", "partner", "director")),
    (r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)\s*[-–—|,]\s*(?:Founder|Co-Founder|CEO|Owner|President|Creator)",
     _ROLES),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[\r\n,–—|-]+\s*(?:Co-Founder|Founder|CEO|Owner|COO|President|Creator|(?:Managing\s+)?Director)",
     _ROLES + ("coo", "director")),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*\(\s*(?:Owner|Founder|CEO|Co-Founder|President|Director)\s*\)",
     _LEADERS),
    (r"includes\s+([A-Z][a-z]+\s+[A-Z][a-z]+)\s*\(\s*(?:Owner|Founder|CEO|Co-Founder|President|Director)\s*\)",
     ("includes",)),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+and\s+[A-Z][a-z]+\s+[A-Z][a-z]+)?)\s+(?:became|are|is)\s+(?:the\s+)?(?:new\s+)?(?:stewards|owners|founders|growers|caretakers|operators|vintners)",
     ("stewards", "owners", "founders", "growers", "caretakers", "operators", "vintners")),
    (r"(?:means\s+the\s+world\s+to\s+us|with\s+love|sincerely|warmly|cheers|thank\s+you|thanks|from\s+our\s+family)[,\.\s]+([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s*(?:&|and)\s*[A-Z][a-z]+)?\s+[A-Z][a-z]+)",
     ("means", "with", "sincerely", "warmly", "cheers", "thank", "from")),
    (r"(?:grundlagt|stiftet)\s+af\s+([A-ZÆØÅ][a-zæøå]+\s+[A-ZÆØÅ][a-zæøå]+)",
     ("grundlagt", "stiftet")),
    (r"(?:Ejer|Stifter|Grundlægger)[^:\n]*[:\s]+([A-ZÆØÅ][a-zæøå]+\s+[A-ZÆØÅ][a-zæøå]+)",
     ("ejer", "stifter", "grundlægger")),
    (r"(?:curato|gestito)\s+da[:\s]+@?([A-Za-z]+(?:\s+[A-Za-z]+)?)", ("curato", "gestito")),
    (r"(?:through\s+the\s+eyes\s+of|the\s+vision\s+of|envisioned\s+by)\s+([A-Z][a-z]+\s+[A-Z][a-z]+(?:\s*(?:and|&)\s*[A-Z][a-z]+\s+[A-Z][a-z]+)?)",
     ("through", "vision", "envisioned")),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+et\s+[A-Z][a-z]+)?)\s+(?:créent|ont\s+créé|a\s+créé)\s+(?:une|la)\s+marque",
     ("marque",)),
    (r"(?:began|started|born)\s+with\s+[^.!?]{5,120}?[.!?]\s+([A-Z][a-z]+\s+[A-Z][a-z]+)\s+(?:wanted|set\s+out|decided)\s+to\s+(?:build|create|start|launch)",
     ("began", "started", "born")),
    (r"Contacts\s+([A-Z][a-z]+\s+[A-Z][a-z]+)", ("contacts",)),
    (r"(?:LLC|Inc\.|Corp\.|Ltd\.?)\s+([A-Z][a-z]+\s+[A-Z][a-z]+)\s+\d{2,5}\s+[A-Z]",
     ("llc", "inc.", "corp.", "ltd")),
    (r"(?:Key\s+Executive|Executive|Owner|Founder|CEO|President)[s]?\s*[:\-–]\s*([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("executive", "owner", "founder", "ceo", "president")),
    (r"(?:founder|co-founder|owner|ceo|creator)[,\s:]+(?:named\s+)?([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
     ("founder", "owner", "ceo", "creator")),
    (r"(?:Owner\s*&\s*Founder|Founder\s*&\s*Owner|Founder|Co-Founder|CEO|Owner)[,\s:]+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("owner", "founder", "ceo")),
    (r"(?:from\s+our\s+founder|founder\s+and\s+ceo|co-founder)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
     ("founder",)),
    (r"(?:I'm|I am|my name is)\s+([A-Z][a-z]+\s+[A-Z][a-z]+)[,\.\s]+(?:the\s+)?(?:founder|owner|ceo|creator)",
     ("i'm", "i am", "my name is")),
    (r"(?:meet|welcome)\s+([A-Z][a-z]+\s+[A-Z][a-z]+)[,\.]?\s+(?:our|the)?\s*(?:founder|owner|ceo)",
     ("meet", "welcome")),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s+(?:founded|started|launched|created|established)\s+(?:the\s+)?(?:company|brand|store|business|shop)",
     ("founded", "started", "launched", "created", "established")),
    (r'"name"\s*:\s*"([A-Z][a-z]+\s+[A-Z][a-z]+)"[^}]*"@type"\s*:\s*"Person"', ('"person"',)),
    (r'"@type"\s*:\s*"Person"[^}]*"name"\s*:\s*"([A-Z][a-z]+\s+[A-Z][a-z]+)"', ('"person"',)),
    (r"[Ww]ritten\s+by\s+([A-Z][a-z]+\s+[A-Z][a-z]+)", ("written",)),
    (r"[Aa]bout\s+([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[–-]", ("about",)),
    (r"(?:©|\bCopyright\b)\s*\d{4}\s+([A-Z][a-z]+\s+[A-Z][a-z]+)", ("©", "copyright")),
    (r"[Cc]ontact[:\s]+([A-Z][a-z]+\s+[A-Z][a-z]+)[,\s]+(?:Founder|CEO|Owner|President|Director)",
     ("contact",)),
    (r"Registrant Name:\s+([A-Za-z]+\s+[A-Za-z]+)", ("registrant name:",)),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[–-]\s*(?:Founder|Co-Founder|CEO|Owner|President|Director|Owner\s+Operator)[^|]*(?:at|@|of)\s+",
     _LEADERS),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s+is\s+(?:the\s+)?(?:current\s+)?(?:Co-Founder|Founder|CEO|COO|CFO|Owner|Co-Owner|President|Managing\s+Director|Creator)\b",
     _ROLES + ("coo", "cfo", "director")),
    (r"(?:current\s+)?(?:Co-Founder|Founder|CEO|COO|Owner|Co-Owner|President|Creator)(?:[,\s]+[A-Za-z\s]+)?\s+is\s+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     _ROLES + ("coo",)),
    (r"(?:brainchild|creation|vision)\s+of\s+([A-Z][a-z]+\s+[A-Z][a-z]+)",
     ("brainchild", "creation", "vision")),
    (r"(?:we are|I am|we're)\s+(?:the\s+)?(?:founders|co-founders|owners)\s+of\s+[^-–—,.:]+[-–—,:]\s*([A-Z][a-z]+(?:\s*(?:and|&)\s*[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?)",
     ("founders", "owners")),
    (r"([A-Z][a-z]+\s+[A-Z][a-z]+)\s*(?:[-–|,]|\s+)\s*(?:Founder\s*&\s*(?:Co-)?Owner|Founder|Co-Founder|CEO|Owner|President|Creator)\s*(?:at|@|of)\s+",
     _ROLES),
)

# ---------------------------------------------------------------- fixed values
# Short pattern list of the older page step; two or three words, no dictionary
# -----------------------------------------------------------------------------
PAGE_PATTERNS = (
    (r"(?:founded|started|created|launched)\s+by\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
     ("founded", "started", "created", "launched")),
    (r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})\s*,\s*(?:Founder|Co-Founder|CEO|Owner)",
     ("founder", "ceo", "owner")),
    (r"(?:Founder|Co-Founder|CEO|Owner)\s*:\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
     ("founder", "ceo", "owner")),
    (r"meet\s+(?:our\s+founder|the\s+founder)\s*,?\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
     ("meet",)),
    (r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})\s+(?:founded|established)\s+(?:the\s+company|the\s+brand|[A-Z][a-z]+)",
     ("founded", "established")),
)
PAGE_PHRASE_DENY = ("our team", "about us", "customer service", "terms of", "privacy policy",
                    "contact us", "free shipping", "shop all", "all rights", "united states",
                    "new arrivals", "best sellers", "gift card", "press release")

# ---------------------------------------------------------------- fixed values
# Answer boxes of search cards (case matters in the first, not in the second)
# -----------------------------------------------------------------------------
ANSWER_OWNER_PATTERN = (r"(?:Owner|Founder|CEO|Director|Founded by|Owned by|Run by|Created by)"
                        r"\s*:?\s*([A-Z][a-z]{1,15}(?:\s+[A-Z][a-z]{1,20})+)")
ANSWER_PAIR_PATTERN = (r"(?i)(?:owned by|founded by|owners?|founders?)\s+"
                       r"([A-Z][a-z]{2,15})\s+(?:&|and)\s+([A-Z][a-z]{2,15})")
PROFILE_HEAD_PATTERN = r"^([A-Z][a-z]+\s+[A-Z][a-z]+)\s*[-|]"
FOUNDING_YEAR_PATTERN = r"(?i)\b(?:in|est\.?|established(?:\s+in)?)\s+(1[0-9]{3})\b"
FOUNDING_YEAR_FLOOR = 1970

# ---------------------------------------------------------------- fixed values
# Markup and record patterns
# -----------------------------------------------------------------------------
SCHEMA_BLOCK_PATTERN = (r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)"
                        r"</script>")
SCHEMA_ORG_TYPES = ("organization", "localbusiness", "store", "brand")
SCHEMA_PERSON_KEYS = ("founder", "director", "employee", "author", "creator")
SCHEMA_JOB_TERMS = ("founder", "ceo", "owner", "president", "director", "creator")
FEED_EMAIL_PATTERN = r"(?i)<(?:author|managingEditor)>[^<]*<email>([^<]+)</email>"
FEED_EDITOR_PATTERN = r"<managingEditor>([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"
FEED_AUTHOR_PATTERN = (r"<(?:dc:creator|author)>\s*(?:<name>)?([A-Z][a-z]+\s+[A-Z][a-z]+)"
                       r"(?:</name>)?\s*</(?:dc:creator|author)>")
COMPANY_NUMBER_PATTERN = (r"(?i)(?:Company\s*(?:Registration\s*)?No\.?|Company\s*Number|"
                          r"Registered\s*(?:in\s*England\s*(?:and\s*Wales)?\s*)?(?:under\s*)?"
                          r"(?:Company\s*)?Number|(?:Company\s*)?Registration\s*Number)"
                          r"[:\s]+([0-9]{7,8})\b")
REGISTRANT_LINE_PATTERN = (r"(?i)(?:Registrant|Admin|Owner)(?:\s+(?:Contact|Name|Person|"
                           r"Details))*[:\s]+([A-Za-z\s]+)$")
BIO_PATTERN = r'"biography"\s*:\s*"([^"]{10,200})"'
VIDEO_HANDLE_PATTERN = r"youtube\.com/@([A-Za-z]+)"
REDIRECT_PATTERN = r"/RU=(.*?)/RK="
