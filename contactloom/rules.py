"""Word lists, lookup tables, patterns and formats.

Everything in this module is data that results depend on. The logic that reads it
lives in ``functions`` and ``operators``. Dictionaries over a couple of hundred
entries (given names, stop words, person directories, brand registries) are not
here: callers pass them in as tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Categories and their declared orders
# -----------------------------------------------------------------------------
JEWELRY = "Jewelry"
APPAREL = "Fashion & Apparel"
ACCESSORIES = "Fashion Accessories"
HEALTH = "Health & Supplements"
GENERAL = "Extended DTC"

CATEGORIES = (JEWELRY, APPAREL, ACCESSORIES, HEALTH, GENERAL)

CATEGORY_TREE = {
    APPAREL: ("Streetwear", "Athleisure", "Denim", "Outerwear", "Casual", "Formal",
              "Plus-size", "Swimwear", "Loungewear", "Kids apparel"),
    ACCESSORIES: ("Hats & caps", "Bags & handbags", "Belts", "Sunglasses & eyewear",
                  "Watches", "Scarves & wraps", "Wallets", "Hair accessories"),
    JEWELRY: ("Chains", "Pendants & necklaces", "Rings", "Bracelets", "Earrings",
              "Lab-grown diamonds", "Natural diamonds", "Men's jewelry", "Custom jewelry"),
    HEALTH: ("Vitamins & multivitamins", "Protein & fitness", "Weight management",
             "Collagen & skin", "Sleep & wellness", "Gut health & probiotics",
             "Energy & pre-workout", "Women's health", "Men's health"),
    GENERAL: ("Skincare & Beauty", "Pet products", "Home & lifestyle", "Tech accessories",
              "Candles & fragrance", "Outdoor & camping", "Kitchenware"),
}
TARGET_ROLES = ("Founder", "Co-Founder", "CEO", "Chief Executive Officer", "CMO",
                "Chief Marketing Officer", "Head of Marketing", "VP Marketing",
                "Marketing Director", "Owner", "Co-Owner")
TARGET_COUNTRIES = ("United States", "United Kingdom", "Canada", "Australia", "Germany",
                    "France", "Netherlands", "United Arab Emirates")
EMPLOYEE_BANDS = ("1-10", "11-50", "51-100")
REVENUE_BANDS = ("$0–1M", "$1–10M")

# ---------------------------------------------------------------- fixed values
# Keyword rule sets: (category, terms) in evaluation order
# -----------------------------------------------------------------------------
_HEALTH_TERMS = ("supplement", "vitamin", "protein", "nutrition", "wellness", "gut", "sleep",
                 "greens", "organic", "ayurved", "herbal", "remedy", "fitness", "nootropic",
                 "collagen", "creatine", "electrolytes", "superfood", "botanical")
_JEWELRY_TERMS = ("jewelry", "jewel", "diamond", "ring", "gold chain", "silver chain",
                  "chain necklace", "bracelet", "earring", "gem", "gemstone", "bridal",
                  "pendant", "cufflink", "moissanite", "bangle", "karat")
_ACCESSORY_TERMS = ("watch", "wallet", "bag", "sunglasses", "eyewear", "belt", "hat",
                    "backpack", "tote", "handbag", "luggage", "footwear", "purse", "shades",
                    "beanie", "shoe", "sneaker", "optician")
_GENERAL_TERMS = ("skin", "serum", "beauty", "cosmetic", "cream", "shampoo", "candle", "pet",
                  "dog", "cookware", "haircare", "bodycare", "soap", "scent", "kitchen",
                  "coffee", "tea")
_APPAREL_TERMS = ("clothing", "apparel", "wear", "fashion", "denim", "shirt", "dress", "swim",
                  "streetwear", "athletic", "hoodie", "jeans", "outfit", "swimwear",
                  "activewear", "boutique", "saree", "kurti", "loom", "textile", "suit")

REGISTRY_KEYWORDS = (
    (HEALTH, _HEALTH_TERMS),
    (JEWELRY, _JEWELRY_TERMS),
    (ACCESSORIES, _ACCESSORY_TERMS),
    (GENERAL, _GENERAL_TERMS),
    (APPAREL, _APPAREL_TERMS),
)
FALLBACK_KEYWORDS = (
    (HEALTH, _HEALTH_TERMS),
    (JEWELRY, _JEWELRY_TERMS),
    (ACCESSORIES, _ACCESSORY_TERMS),
    (APPAREL, _APPAREL_TERMS),
    (GENERAL, _GENERAL_TERMS),
)
HARVEST_KEYWORDS = (
    (HEALTH, tuple("electrolyte" if t == "electrolytes" else t for t in _HEALTH_TERMS)),
    (JEWELRY, _JEWELRY_TERMS),
    (ACCESSORIES, _ACCESSORY_TERMS),
    (APPAREL, _APPAREL_TERMS),
    (GENERAL, _GENERAL_TERMS),
)
RANKED_KEYWORDS = (
    (HEALTH, ("supplement", "vitamin", "protein", "nutrition", "wellness", "gut", "fitness",
              "organic", "remedy", "herb", "nootropic", "collagen", "pharma", "bio", "health",
              "cbd", "hemp", "serum", "creatine", "electrolytes", "superfood", "botanical")),
    (JEWELRY, ("jewelry", "jewel", "diamond", "ring", "chain", "silver", "gold", "bracelet",
               "gem", "necklace", "earring", "gemstone", "bridal", "pendant", "customjewelry",
               "finejewelry", "moissanite", "cufflink")),
    (ACCESSORIES, ("watch", "wallet", "bag", "eyewear", "sunglass", "belt", "hat", "tote",
                   "backpack", "leather", "purse", "handbag", "luggage", "footwear", "boot",
                   "sneaker", "optical", "cases", "scarf", "beanie", "cap", "shades")),
    (GENERAL, ("skin", "beauty", "cosmetic", "candle", "pet", "dog", "cat", "cookware",
               "coffee", "tea", "soap", "scent", "kitchen", "glow", "lash", "hair",
               "fragrance", "perfume", "decor", "baby", "pan", "blade", "grooming")),
    (APPAREL, ("clothing", "apparel", "wear", "fashion", "denim", "shirt", "dress", "swim",
               "streetwear", "athletic", "hoodie", "jeans", "outfit", "swimwear",
               "activewear", "lingerie", "tee", "tailor", "couture", "boutique", "jacket",
               "legging", "sweats")),
)
RANKED_INDICATORS = ("shop", "store", "brand", "market", "goods", "outlet", "direct", "boutique")
RANKED_DENIED_SUFFIXES = (".edu", ".gov", ".mil", ".org", ".int", ".cn", ".ru", ".ir")
RANKED_DENIED_TERMS = ("cdn", "api", "dev", "static", "mail", "ns1", "ns2", "admin", "portal",
                       "cloud", "server", "blog")
RANKED_ORDER = (HEALTH, JEWELRY, ACCESSORIES, GENERAL, APPAREL)
INLINE_KEYWORDS = (
    (JEWELRY, ("jewelry", "jewel", "diamond", "ring", "pendant", "necklace", "bracelet",
               "earring", "gemstone")),
    (HEALTH, ("supplement", "vitamin", "protein", "nutrition", "wellness", "ayurved", "herbal",
              "nootropic")),
    (ACCESSORIES, ("watch", "wallet", "sunglass", "eyewear", "belt", "backpack", "tote",
                   "handbag", "luggage")),
    (APPAREL, ("clothing", "apparel", "streetwear", "athleisure", "denim", "shirt", "dress",
               "hoodie")),
)
# (category, sub-category, terms)
PAGE_KEYWORDS = (
    (HEALTH, "Nutrition & Wellness",
     ("supplement", "vitamin", "protein", "nutrition", "wellness", "gut", "sleep", "greens",
      "organic", "ayurved", "herbal", "remedy")),
    (JEWELRY, "Fine Jewelry & Chains",
     ("jewelry", "jewel", "necklace", "ring", "diamond", "gold chain", "silver chain",
      "bracelet", "earring", "gemstone", "pendant", "cufflink")),
    (ACCESSORIES, "Bags & Everyday Accessories",
     ("watch", "wallet", "bag", "sunglasses", "eyewear", "belt", "hat", "backpack", "tote",
      "handbag")),
    (GENERAL, "Skincare & Home Goods",
     ("skin", "serum", "beauty", "cosmetic", "cream", "shampoo", "candle", "pet", "dog",
      "cookware", "haircare", "bodycare")),
)
PAGE_DEFAULT = (APPAREL, "Apparel & Streetwear")
RANKED_PAGE_KEYWORDS = (
    (HEALTH, "Nutrition & Wellness",
     ("supplement", "vitamin", "protein", "nutrition", "wellness", "gut", "sleep", "greens",
      "organic", "creatine")),
    (JEWELRY, "Fine Jewelry & Chains",
     ("jewelry", "jewel", "necklace", "ring", "diamond", "chain", "bracelet", "earring",
      "silver", "gold")),
    (ACCESSORIES, "Bags & Everyday Accessories",
     ("watch", "wallet", "bag", "sunglasses", "eyewear", "belt", "hat", "backpack", "tote")),
    (GENERAL, "Skincare & Home Goods",
     ("skin", "serum", "beauty", "cosmetic", "cream", "shampoo", "candle", "pet", "dog",
      "cookware")),
    (APPAREL, "Apparel & Streetwear",
     ("clothing", "apparel", "denim", "dress", "hoodie", "shirt", "jeans", "streetwear",
      "athletic")),
)

# ---------------------------------------------------------------- fixed values
# Strict rule set: brand overrides first, then include/exclude groups
# -----------------------------------------------------------------------------
BRAND_OVERRIDES = (
    (JEWELRY, ("giva", "artkarat", "amama", "pehrsilver", "sonchafa", "dhwanibansal", "pratha",
               "etchcraft", "einaya", "sukkhi", "renaush", "diamondrensu", "ornatejewels",
               "leafyaffair", "shoprmcgems", "gemkart", "abagem", "bellarosagems",
               "houseofquadri", "bluestone", "caratlane", "tanishq")),
    (HEALTH, ("nutrabox", "bioayurveda", "manaayurvedam", "himalayawellness",
              "indiahemporganics", "indiahempandco", "sasya", "artofliving", "kapiva", "oziva",
              "fastandup", "muscleblaze")),
    (APPAREL, ("zeelclothing", "bunaai", "fashor", "frenchcrown", "bummer", "thehandlooms",
               "shopethnos", "snitch", "bewakoof")),
    (ACCESSORIES, ("helios", "boat-lifestyle", "hammer", "fireboltt", "neemans", "urbanmonkey",
                   "gemopticians", "bumsonthesaddle")),
    (GENERAL, ("pawsindia", "detoxie", "fuaointerio", "fuaosanitaryware", "cartrends",
               "kitchenandhome", "indulekha", "swissbeauty", "reequil", "plumgoodness",
               "veeba", "nurserylive", "sleepyowl", "ragecoffee", "happilo", "headsupfortails",
               "lakmeindia", "juicychemistry", "bellavitaorganic", "devsmusic", "codesustain",
               "neonia", "halfrate", "resanskrit", "aumnicrafts", "seelove", "kamakhyaa",
               "urbancart", "kent", "kazeliving", "justwowfactory", "aubree", "shinexpro",
               "zestpics", "gemeriahair", "systemgemisch", "runningemotion", "gaugemagazine",
               "sp-villa-management")),
)
# (category, includes, excludes)
STRICT_RULES = (
    (JEWELRY,
     ("jewel", "diamond", "moissanite", "gemstone", "pendant", "earring", "necklace",
      "bracelet", "bangle", "karat", "gems"),
     ("supplement", "protein", "vitamin", "hair", "optician", "eyewear", "auto", "car", "bike",
      "cycle", "villa", "management", "running", "sport", "sanitary", "plumb", "shoe",
      "footwear", "candle", "pet", "dog", "cat", "coffee", "tea", "cloth", "apparel", "dress",
      "shirt", "system", "magazine")),
    (HEALTH,
     ("supplement", "vitamin", "protein", "nutrition", "ayurved", "herbal", "wellness",
      "gut health", "immunity", "nootropic", "superfood", "greens"),
     ("eyewear", "jewelry", "pet", "dog", "cat", "auto", "villa", "shoe", "cloth", "apparel")),
    (APPAREL,
     ("clothing", "apparel", "wear", "dress", "shirt", "denim", "jeans", "hoodie",
      "streetwear", "boutique", "swimwear", "activewear", "suit", "saree", "kurti", "loom",
      "textile", "outfit"),
     ("jewel", "diamond", "supplement", "vitamin", "protein", "dog", "cat", "pet", "car",
      "auto", "sanitary", "candle")),
    (ACCESSORIES,
     ("watch", "wallet", "bag", "eyewear", "sunglasses", "optician", "belt", "hat",
      "footwear", "shoe", "handbag", "tote", "backpack", "sneaker", "purse", "earphone",
      "strap"),
     ("supplement", "protein", "vitamin", "auto", "car", "sanitary", "dog", "cat", "pet",
      "jewel", "diamond")),
)

# ---------------------------------------------------------------- fixed values
# Address patterns, block terms, provider rules
# -----------------------------------------------------------------------------
EMAIL_PATTERN = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+"
MAILTO_HREF_PATTERN = r"""(?i)href=["']mailto:([^"'?\s]+)"""
MAILTO_ANY_PATTERN = r"(?i)mailto:([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"
XOR_ATTRIBUTE_PATTERN = r"""data-cfemail=["']([0-9a-fA-F]+)["']"""
SWEEP_EMAIL_PATTERN = (r"(?<![\w@])([a-zA-Z0-9][a-zA-Z0-9._%+-]{1,40}@[a-zA-Z0-9][a-zA-Z0-9.-]"
                       r"{1,40}\.[a-zA-Z]{2,10})(?![\w@])")
BLOCK_TERMS = (
    "png", "jpg", "jpeg", "gif", "webp", "svg", "sentry", "shopify.com", "w3.org", "email.com",
    "example.com", "schema.org", "cloudflare", "support@shopify", "help@shopify", "google.com",
    "facebook.com", "twitter.com", "instagram.com", "github.com", "spurit", "klaviyo", "yotpo",
    "judge.me", "apps.shopify", "myshopify.com", "wordpress", "wix.com", "squarespace.com",
    "zendesk.com", "intercom-mail", "beispiel.com", "domain.com", "yoursite.com", "test@",
    "dayjs@", "core-js@", "npm@", "deine-email@", "tempuri.org", "doubleclick", "user@",
    "admin@example", "info@yourdomain.com", "no-reply", "noreply",
)
HARVEST_BLOCK_TERMS = tuple(t for t in BLOCK_TERMS if t != "deine-email@")
RANKED_BLOCK_TERMS = BLOCK_TERMS[:31]
CRAWL_BLOCK_TERMS = BLOCK_TERMS[:26]
DUMMY_DOMAINS = ("example.com", "domain.com", "beispiel.com", "email.com", "yoursite.com",
                 "sentry.io", "schema.org", "w3.org")

# mail domain -> provider, all with MX, DMARC and SPF
KNOWN_PROVIDERS = {
    "gmail.com": "Google Workspace", "googlemail.com": "Google Workspace",
    "yahoo.com": "Yahoo Mail", "hotmail.com": "Microsoft 365", "outlook.com": "Microsoft 365",
    "icloud.com": "Apple iCloud", "me.com": "Apple iCloud", "zoho.com": "Zoho Mail",
    "proton.me": "ProtonMail", "protonmail.com": "ProtonMail",
}
HARVEST_KNOWN_PROVIDERS = {
    **KNOWN_PROVIDERS, "yahoo.co.in": "Yahoo Mail", "fastmail.com": "Fastmail",
    "hey.com": "Fastmail", "aol.com": "AOL Mail",
}
# rule set -> ((substrings, label), ..., default)
PROVIDER_RULES = {
    "inbox": ((("google",), "Google Workspace"), (("outlook", "microsoft"), "Microsoft 365"),
              (("zoho",), "Zoho Mail"), "Host MX"),
    "verifier": ((("google",), "Google Workspace"),
                 (("outlook.com", "microsoft"), "Microsoft 365"), (("zoho",), "Zoho Mail"),
                 (("protonmail",), "ProtonMail"),
                 (("mimecast", "proofpoint"), "Enterprise Gateway"), "Custom/Host MX"),
    "harvest": ((("google",), "Google Workspace"), (("microsoft",), "Microsoft 365"),
                (("outlook",), "Microsoft 365"), (("zoho",), "Zoho Mail"),
                (("proton",), "ProtonMail"), (("fastmail",), "Fastmail"),
                (("amazon",), "Amazon SES"), (("mailgun",), "Mailgun"),
                (("sendgrid",), "SendGrid"), (("mimecast",), "Mimecast"), "Host MX"),
    "fingerprint": ((("google", "gmail", "googlemail", "aspmx"), "Google Workspace"),
                    (("outlook", "hotmail"), "Microsoft 365"),
                    (("protonmail", "proton.me"), "ProtonMail"), (("yahoo",), "Yahoo Mail"),
                    (("zoho",), "Zoho Mail"), (("fastmail",), "Fastmail"),
                    (("mailgun",), "Mailgun"), (("sendgrid",), "SendGrid"),
                    (("amazonaws", "aws"), "AWS SES"), "Custom SMTP"),
}
NO_MX = "No MX"

# Candidate scores: own, role prefixes, role score, info score (None: as role), other
CANDIDATE_WEIGHTS = {
    "worker": (100, ("support@", "care@", "hello@", "team@", "founder@", "service@", "contact@",
                     "sales@", "info@"), 85, None, 60),
    "harvest": (95, ("support@", "care@", "hello@", "team@", "founder@", "service@", "contact@",
                     "sales@", "info@", "admin@", "hi@", "hey@", "shop@", "order@", "help@"),
                80, None, 55),
    "crawl": (100, ("support@", "care@", "hello@", "team@", "founder@", "service@", "contact@",
                    "sales@"), 80, 60, 40),
}
MAILTO_SCORE = 100

# Local part -> (terms, title, first, last); then the split form
ROLE_RULES = {
    "worker": (
        (("support", "care", "service", "help"),
         "Customer Care / Operations Lead", "Support", "Lead"),
        (("marketing", "growth", "media", "press", "pr", "ads"),
         "Head of Marketing & Growth", "Marketing", "Lead"),
        (("info", "contact", "hello", "team", "sales", "office", "admin"),
         "Founder / Marketing Lead", "Founder", "Team"),
    ),
    "crawl": (
        (("support", "care", "service", "help"),
         "Customer Care / Operations Lead", "Support", "Lead"),
        (("marketing", "growth", "media", "press", "pr"),
         "Head of Marketing & Growth", "Marketing", "Lead"),
        (("info", "contact", "hello", "team", "sales", "office", "admin"),
         "Founder / Marketing Lead", "Founder", "Team"),
    ),
}
ROLE_DEFAULT_TITLE = "Founder & Owner"
ROLE_INBOXES = (
    "info", "contact", "hello", "hi", "admin", "support", "sales", "service", "services",
    "orders", "billing", "shipping", "returns", "help", "enquiry", "enquiries", "press",
    "media", "marketing", "advertising", "wholesale", "general", "office", "team", "shop",
    "store", "boutique", "care", "privacy", "legal", "hr", "jobs", "careers", "feedback",
    "newsletter", "booking", "bookings", "noreply", "no-reply", "mailer", "bounce",
    "postmaster", "abuse", "security", "webmaster", "hostmaster", "accounts", "account",
    "logistics", "operations", "partnerships", "concierge",
)
ROLE_LOCAL_PARTS = (
    "marketing", "advertising", "accounting", "billing", "shipping", "orders", "sales",
    "support", "service", "services", "office", "admin", "contact", "info", "help",
    "inquiries", "team", "hello", "hi", "general", "press", "media", "customercare", "care",
    "booking", "bookings", "frontdesk", "concierge", "editorial", "feedback", "operations",
    "partnerships", "careers", "jobs", "hr", "privacy", "legal", "security", "enquiry",
    "enquiries", "retail", "wholesale", "returns", "logistics",
)
SURNAME_PARTICLES = ("al", "el", "de", "du", "da", "di", "van", "der", "von", "la", "le", "co",
                     "corp", "inc", "ltd", "llc", "gmbh", "bv", "sa", "sarl", "kunden", "kunde")
HONORIFICS = ("don ", "sir ", "lord ", "lady ", "dame ", "saint ", "st. ")
TRAILING_WORDS = ("as", "of", "at", "for", "in", "on", "to", "by", "and", "or", "the")

# ---------------------------------------------------------------- fixed values
# Social links
# -----------------------------------------------------------------------------
PLATFORMS = ("instagram", "facebook", "linkedin", "tiktok", "twitter")
SHARE_MARKERS = ("/sharer", "share.php", "intent/tweet", "pin/create", "/p/", "/reel/",
                 "/stories/", "instagram.com/instagram", "facebook.com/facebook",
                 "twitter.com/twitter", "whatsapp.com", "mailto:", "javascript:")
RESERVED_HANDLES = {
    "instagram": ("explore", "accounts", "direct", "stories"),
    "facebook": ("groups", "policies", "help", "pages"),
    "linkedin": (),
    "tiktok": (),
    "twitter": ("intent", "share", "home"),
}
HARVEST_SOCIAL_PATTERNS = {
    "instagram": r'(?i)https?://(?:www\.)?instagram\.com/([\w.]{2,40})(?:[/?"\s]|$)',
    "facebook": r'(?i)https?://(?:www\.)?facebook\.com/([\w.-]{2,60})(?:[/?"\s]|$)',
    "linkedin": r'(?i)https?://(?:www\.)?linkedin\.com/company/([\w-]{2,60})(?:[/?"\s]|$)',
    "tiktok": r'(?i)https?://(?:www\.)?tiktok\.com/@([\w.]{2,40})(?:[/?"\s]|$)',
    "twitter": r'(?i)https?://(?:www\.)?(?:twitter|x)\.com/(\w{2,40})(?:[/?"\s]|$)',
}
PROFILE_PREFIX = {
    "instagram": "https://www.instagram.com/",
    "facebook": "https://www.facebook.com/",
    "linkedin": "https://www.linkedin.com/company/",
    "tiktok": "https://www.tiktok.com/@",
    "twitter": "https://x.com/",
}
HARVEST_RESERVED = ("explore", "accounts", "direct", "stories", "p", "reel", "tv", "groups",
                    "policies", "help", "pages", "intent", "share", "home", "hashtag",
                    "trending", "music", "search", "facebook", "instagram", "twitter",
                    "linkedin", "tiktok")

# ---------------------------------------------------------------- fixed values
# Page paths, page markers
# -----------------------------------------------------------------------------
CONTACT_HINTS = ("contact", "about-us", "about", "help", "support", "touch")
CONTACT_HINTS_RELATIVE = ("contact", "pages/contact", "about-us", "get-in-touch")
CRAWL_PATHS = ("/pages/contact-us", "/pages/contact", "/contact-us", "/contact",
               "/pages/about-us", "", "/policies/privacy-policy", "/policies/terms-of-service")
ABOUT_HINTS = ("about", "story", "team", "founder", "history", "who-we-are", "bio", "artisan",
               "meet", "creator", "our-mission", "family", "impressum", "legal", "mentions",
               "over-ons")
ABOUT_SKIPS = ("/products/", "/collections/", "/blogs/", "/cart", "/checkout", "/account",
               "/search")
ABOUT_PATHS = (
    "/policies/legal-notice", "/policies/contact-information", "/pages/about-us",
    "/pages/our-story", "/pages/about", "/about", "/pages/contact-us", "/pages/contact",
    "/contact-us", "/contact", "/pages/impressum", "/impressum", "/pages/mentions-legales",
    "/policies/terms-of-service", "/pages/terms-and-conditions", "/terms-and-conditions",
    "/pages/meet-the-team", "/pages/meet-us", "/pages/team", "/pages/founder",
    "/pages/founders", "/pages/meet-the-founder", "/pages/who-we-are", "/pages/our-mission",
    "/pages/our-company", "/pages/bio", "/pages/my-story", "/pages/your-story",
    "/pages/the-maker", "/pages/the-artist", "/pages/the-designer", "/over-ons", "/uber-uns",
    "/chi-siamo", "/sobre-nosotros", "/a-propos", "/qui-sommes-nous", "/pages/privacy-policy",
)
CHROME_TAGS = ("script", "style", "nav", "footer", "header")
SHOP_MARKERS = ("cdn.shopify.com", "Shopify.shop", "myshopify.com", "/cart", "/checkout")
SHOP_WORDS = ("cart", "bag", "checkout", "add to cart", "shop now", "free shipping")
PIXEL_PATTERN = r"""fbq\(\s*['"]init['"]\s*,\s*['"](\d+)['"]"""
TRACKING_MARKERS = ("connect.facebook.net/en_US/fbevents.js", "facebook.com/tr?id=")
SIGNAL_HIGH = "High (Meta Pixel Installed)"
SIGNAL_MEDIUM = "Medium (Meta Tracking Present)"
SIGNAL_NONE = "Unverified"

# ---------------------------------------------------------------- fixed values
# Hosts, suffixes, countries
# -----------------------------------------------------------------------------
TRUSTED_HOSTS = (
    "zoominfo.com", "dnb.com", "dandb.com", "buzzfile.com", "crunchbase.com", "datanyze.com",
    "bizapedia.com", "linkedin.com", "bloomberg.com", "rocketreach.co", "cortera.com",
    "opencorporates.com", "owler.com", "manta.com", "bbb.org", "yellowpages.com", "yelp.com",
    "clutch.co", "trustpilot.com", "glassdoor.com", "angel.co", "producthunt.com",
    "pitchbook.com", "cbinsights.com", "craft.co", "signalhire.com", "apollo.io", "hunter.io",
    "indiamart.com", "zaubacorp.com", "tofler.in", "thecompanycheck.com", "northdata.com",
    "societe.com", "verif.com", "kompass.com", "tracxn.com",
    "find-and-update.company-information.service.gov.uk", "abr.business.gov.au", "sec.gov",
)
STRICT_TRUSTED_HOSTS = TRUSTED_HOSTS[:12]
DENIED_HOSTS = ("wikipedia.org", "wiktionary.org", "thefreedictionary.com", "coupons.com",
                "retailmenot.com", "slickdeals.net", "facebook.com/login",
                "accounts.google.com", "support.google.com", "whois", "domaintools",
                "godaddy.com", "namecheap.com")
DIRECTORY_PAGE = "/pub/dir/"
PROFILE_HOSTS = ("crunchbase.com", "angel.co", "producthunt.com")
# Suffixes the company registry step skips, and those its caller skips beforehand
REGISTRY_SKIP_SUFFIXES = (
    ".my", ".au", ".nz", ".ca", ".de", ".fr", ".it", ".es", ".nl", ".in", ".jp", ".kr", ".cn",
    ".br", ".mx", ".sg", ".hk", ".za", ".ch", ".at", ".be", ".dk", ".se", ".no", ".fi", ".pl",
    ".cz", ".gr", ".pt", ".ro", ".hu", ".ie", ".il", ".ae", ".sa", ".rs", ".bg", ".hr", ".sk",
    ".si", ".lt", ".lv", ".ee", ".global", ".shop", ".store", ".tech", ".space", ".online",
    ".site", ".app", ".co", ".io", ".ai", ".me", ".us",
)
GATE_SUFFIXES = (
    ".de", ".fr", ".it", ".se", ".dk", ".au", ".tw", ".in", ".ca", ".nz", ".rs", ".nl", ".be",
    ".ch", ".es", ".pt", ".no", ".fi", ".pl", ".cz", ".at", ".ru", ".jp", ".kr", ".cn", ".za",
    ".ky", ".ae", ".my", ".pk", ".sg", ".hk", ".id", ".th", ".vn", ".ph", ".br", ".mx", ".ar",
    ".cl", ".co", ".pe", ".ie", ".eu", ".asia", ".global",
)
COUNTRY_RULES = {
    "labels": (((".com", ".us"), "United States"), ((".co.uk", ".uk"), "United Kingdom"),
               ((".ca",), "Canada"), ((".au", ".com.au"), "Australia"), ((".in",), "India"),
               "International"),
    "binary": (((".com", ".us"), "United States"), "International"),
    "com_only": (((".com",), "United States"), "International"),
}
TWO_LEVEL_CODES = {"co.uk": "UK", "org.uk": "UK", "me.uk": "UK", "ltd.uk": "UK",
                   "com.au": "AU", "net.au": "AU", "org.au": "AU"}
ONE_LEVEL_CODES = {"uk": "UK", "au": "AU", "ca": "CA", "com": "US", "net": "US", "org": "US",
                   "io": "US", "co": "US"}
OTHER_CODE = "INTL"
HOME_MARKERS = ("england", "wales", "united kingdom", "gbp", "£")
GROUNDING_PREFIX_STOPS = ("the", "and", "com", "net", "org", "shop", "store", "online", "inc",
                          "llc", "ltd", "co")
GROUNDING_TOKEN_STOPS = ("the", "and", "shop", "store", "online", "inc", "llc", "ltd", "with",
                         "from", "your", "that", "this", "they", "have", "been", "com", "net",
                         "org", "global", "co")
PRIVACY_WORDS = ("privacy", "redacted", "whoisguard", "proxy", "gdpr", "contact", "domains",
                 "service", "inc", "llc", "ltd", "corporation")
PRIVACY_NAMES = ("privacy", "proxy", "redacted", "whoisguard")

# ---------------------------------------------------------------- fixed values
# Text templates and output formats
# -----------------------------------------------------------------------------
PHRASES = {
    JEWELRY: "Fine Jewelry & Precious Ornaments",
    APPAREL: "Fashion & Apparel Collections",
    ACCESSORIES: "Fashion Accessories & Lifestyle",
    HEALTH: "Health, Wellness & Nutritional Supplements",
    GENERAL: "DTC & Consumer Goods",
}
PHRASE_DEFAULT = "DTC Brand Marketing"
PHRASE_TEMPLATE = ("Saw {brand}'s live campaigns in {phrase} — noticed a high-leverage "
                   "opportunity to test iterative UGC hooks and creative variations to scale "
                   "Meta spend profitably.")
TEMPLATES = {
    JEWELRY: "Loved what {brand} is doing with fine jewelry — the craftsmanship truly stands "
             "out.",
    APPAREL: "Really impressed by {brand}'s curated collections — the attention to style is "
             "evident.",
    ACCESSORIES: "Your accessories at {brand} strike a perfect balance between form and "
                 "function.",
    HEALTH: "The focus {brand} puts on clean, effective formulas is exactly what customers "
            "need.",
    GENERAL: "The brand story at {brand} is compelling — would love to help amplify it "
             "further.",
}
SEARCH_URLS = {
    "keyword": ("https://www.facebook.com/ads/library/?active_status=active&ad_type=all"
                "&country=ALL&q={query}&search_type=keyword_unordered&media_type=all"),
    "short": "https://www.facebook.com/ads/library/?q={query}&type=all",
}
PROFILES = {
    "master": ("First Name", "Last Name", "Email", "Secondary_Email", "Company", "Website",
               "Title", "Meta Ads Library URL", "Niche", "Country", "Instagram", "Facebook",
               "LinkedIn", "TikTok", "Twitter_X", "MX_Status", "DMARC_Status", "SPF_Status",
               "Gravatar_Found", "Deliverability_Score", "Personalized Icebreaker"),
    "crm": ("First Name", "Last Name", "Title", "Email", "Email Status", "Mail Provider",
            "Company", "Domain", "Website", "Meta Ads Library URL", "Ad Active Signal",
            "E-commerce Platform", "Niche", "Sub-Niche", "Country", "Employee Band",
            "Instagram", "Personalized Icebreaker"),
    "crawl": ("First Name", "Last Name", "Title", "Email", "Secondary_Email", "Email Status",
              "Mail Provider", "Company", "Domain", "Website", "Meta Ads Library URL",
              "Ad Active Signal", "E-commerce Platform", "Niche", "Sub-Niche", "Country",
              "Employee Band", "Personalized Icebreaker"),
    "social": ("First Name", "Last Name", "Email", "Secondary_Email", "Company", "Website",
               "Title", "Meta Ads Library URL", "Niche", "Country", "Instagram", "Facebook",
               "LinkedIn", "TikTok", "Twitter_X", "Personalized Icebreaker"),
    "upload": ("First Name", "Last Name", "Email", "Company", "Website", "Title",
               "Meta Ads Library URL", "Niche", "Country", "Personalized Icebreaker"),
    "upload_secondary": ("First Name", "Last Name", "Email", "Secondary_Email", "Company",
                         "Website", "Title", "Meta Ads Library URL", "Niche", "Country",
                         "Personalized Icebreaker"),
}
# export header -> column of the contact table
HEADER_COLUMNS = {
    "First Name": "first_name", "Last Name": "last_name", "Email": "email",
    "Secondary_Email": "secondary_email", "Company": "company", "Website": "website",
    "Title": "title", "Meta Ads Library URL": "ads_url", "Niche": "niche",
    "Country": "country", "Instagram": "instagram", "Facebook": "facebook",
    "LinkedIn": "linkedin", "TikTok": "tiktok", "Twitter_X": "twitter_x",
    "MX_Status": "mx_status", "DMARC_Status": "dmarc_status", "SPF_Status": "spf_status",
    "Gravatar_Found": "profile_found", "Deliverability_Score": "score",
    "Personalized Icebreaker": "note", "Email Status": "email_status",
    "Mail Provider": "provider", "Domain": "domain", "Ad Active Signal": "ad_signal",
    "E-commerce Platform": "platform", "Sub-Niche": "sub_niche",
    "Employee Band": "employee_band",
}
# Defaults of the inbox step
INBOX_DEFAULTS = {"first_name": "Founder", "last_name": "Team",
                  "title": "Founder / Marketing Lead", "country": "United States"}
INBOX_DEFAULT_CATEGORY = APPAREL
DMARC_ON, DMARC_OFF = "Configured (v=DMARC1)", "Not Configured"
SPF_ON, SPF_OFF = "Configured", "None"
SLICE_COLUMNS = ("domain", "brand", "niche", "tech", "employees")
ALIASES = {
    "domain": ("domain", "Domain", "url", "URL"),
    "brand": ("merchant_name", "brand", "company", "name"),
    "tech": ("technologies",),
    "tags": ("tags",),
    "employees": ("employee_count_bucket",),
}
CONFIDENCE_RANK = {"VERIFIED": 4, "HIGH": 3, "MEDIUM": 2, "STANDARD": 1}
QUOTA_PER_CATEGORY = 25000
SLICE_COUNT = 10
BATCH_ROWS = 2000
PASS_GATE = 70.0

# ---------------------------------------------------------------- fixed values
# Brand-from-domain tokens
# -----------------------------------------------------------------------------
BRAND_TOKENS = {
    "crawl": (r"(?i)^(shop|the|my|get|try|buy|store)", r"(?i)(shop|store|online|co|brand)$"),
    "ranked": (r"(?i)^(shop|the|my|get|try|buy|store|wear)",
               r"(?i)(shop|store|online|co|brand|official)$"),
}
