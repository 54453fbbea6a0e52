"""Word lists, patterns, labels and lookup tables of the contact domain, in natural order."""

# Cells that stand for "no value" when a staging table is profiled.
PLACEHOLDERS = ["", "?", "-", "--", "n/a", "na", "none", "null", "unknown", "not known", "tbd", "x"]
NAME_PLACEHOLDERS = [*PLACEHOLDERS, "contact", "contact person", "kontakt", "team", "office", "info", "general", "not available"]
EMAIL_NOISE = ["contact us", "kontakt", "email:", "e-mail:", "mail:", " or ", " oder ", ";", "|", "\n"]
URL_MARKERS = ["http://", "https://", "www."]

# Names that are cleared when contacts are cleaned, and names that look generic.
INVALID_NAMES = [
    "", "?", "-", "--", "n/a", "na", "none", "null", "unknown", "not known", "tbd", "x", "domain", "email", "e-mail", "mail", "website", "web", "url", "contact",
    "contact person", "kontakt", "organisation", "organization", "name", "phone", "telephone", "address", "contact us", "click here", "see website", "send email",
]
GENERIC_CONTACT_WORDS = ["team", "office", "info", "general", "support", "service", "administration", "admin"]
SEVERAL_PEOPLE_MARKS = [";", "/", " & ", " and ", " und "]
LARGE_CITIES = ["berlin", "hamburg", "munich", "münchen", "cologne", "köln", "frankfurt", "leipzig", "dresden", "potsdam"]

# Hosts that are never an organisation's own site.
DIRECTORY_HOSTS = [
    "wikipedia.org", "linkedin.com", "xing.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "vimeo.com", "northdata.com", "dnb.com",
    "crunchbase.com", "bloomberg.com", "glassdoor.com", "kununu.com", "indeed.com", "usgbc.org", "worldgbc.org",
]
MAILBOX_HOSTS = ["gmail.com", "googlemail.com", "google.com", "accounts.google.com", "outlook.com", "hotmail.com", "live.com", "yahoo.com", "icloud.com", "gmx.de", "gmx.net", "web.de", "mail.com"]
BLOCKED_HOSTS = DIRECTORY_HOSTS + MAILBOX_HOSTS

# Page types: authority, words in a path, suffixes to guess, file endings that are no page, labels.
PAGE_PRIORITY = {"Impressum": 6, "Contact": 5, "Footer": 4, "About": 3, "Team": 2, "Homepage": 1}
CONFLICT_GAP = 2
PAGE_WORDS = {
    "Impressum": ["impressum", "imprint", "legal-notice", "legal_notice"],
    "Contact": ["kontakt", "contact", "kontaktiere", "reach-us", "get-in-touch"],
    "About": ["ueber-uns", "uber-uns", "about-us", "about_us", "about", "wer-wir-sind", "who-we-are", "unternehmen", "company", "über-uns"],
    "Team": ["team", "people", "staff", "our-team", "mitarbeiter"],
}
PAGE_GUESSES = {"Impressum": "/impressum", "Contact": "/kontakt", "About": "/ueber-uns", "Team": "/team"}
SKIPPED_ENDINGS = ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "zip", "tar", "gz", "rar", "png", "jpg", "jpeg", "gif", "svg", "webp", "ico", "mp3", "mp4", "avi", "mov", "css", "js"]
METADATA_LABELS = {"Impressum": "Website Impressum", "Contact": "Website contact page", "About": "Website about page", "Team": "Website about page", "Homepage": "Website homepage"}
ADDRESS_LABELS = {"Impressum": "Website Impressum", "Contact": "Website contact page", "About": "Website about page", "Homepage": "Website homepage"}
SOFT_ERROR = r"\b404\b|not found|seite nicht gefunden|page not found|access denied|zugriff verweigert|service unavailable"

# HTTP status texts.
STATUS_TEXTS = {
    200: "OK", 201: "Created", 301: "Moved Permanently", 302: "Found", 400: "Bad Request", 401: "Unauthorized", 403: "Forbidden", 404: "Not Found", 410: "Gone",
    429: "Too Many Requests", 500: "Internal Server Error", 502: "Bad Gateway", 503: "Service Unavailable",
}

# Organisation names that are none.
GENERIC_TITLES = [
    "home", "welcome", "homepage", "start", "startseite", "index", "untitled", "willkommen", "news", "impressum", "imprint", "legal notice", "contact", "kontakt", "about",
    "about us", "seite nicht gefunden", "page not found", "not found",
]
ERROR_NAME = r"\b(?:error\s*)?404\b|not found|seite nicht gefunden|access denied|zugriff verweigert|service unavailable"
TITLE_SEPARATORS = [" | ", " - ", " – ", " — ", " : ", " · "]
ORGANISATION_TYPES_LD = ["Organization", "Corporation", "LocalBusiness", "NGO", "GovernmentOrganization", "EducationalOrganization", "ResearchOrganization", "Nonprofit"]

# Legal forms, most specific first: pattern, written form, organisation type.
LEGAL_FORMS = [
    (r"GmbH\s*&\s*Co\.?\s*KG", "GmbH & Co. KG", "Company"),
    (r"UG\s*\(haftungsbeschr[äa]nkt\)", "UG (haftungsbeschränkt)", "Company"),
    (r"gGmbH", "gGmbH", "Company"),
    (r"gUG", "gUG", "Company"),
    (r"GmbH", "GmbH", "Company"),
    (r"UG\b", "UG", "Company"),
    (r"\bAG\b", "AG", "Company"),
    (r"e\.?\s*V\.?(?:\b|$)", "e.V.", "Association"),
    (r"\bGbR\b", "GbR", "Company"),
    (r"\bOHG\b", "OHG", "Company"),
    (r"\bKG\b", "KG", "Company"),
    (r"\bA[öo]R\b", "AöR", "Public institution"),
    (r"\bKd[öo]R\b", "KdöR", "Public institution"),
    (r"\bStiftung\b", "Stiftung", "Foundation"),
    (r"\bLimited\b", "Limited", "Company"),
    (r"\bLtd\.?\b", "Ltd", "Company"),
    (r"\bInc\.?\b", "Inc", "Company"),
    (r"\bLLC\b", "LLC", "Company"),
]
TYPE_WORDS = [
    (r"\b(?:Hochschule|Universit[äa]t|Fachhochschule|TU\b|FH\b|Institut(?:e)? f[üu]r)\b", "University / research institution"),
    (r"\b(?:research\s+institute|research\s+center|research\s+centre)\b", "University / research institution"),
    (r"\b(?:Stadtwerke|Bezirksamt|Senatsverwaltung|Landesamt|Bundesministerium|Ministerium)\b", "Public institution"),
    (r"\b(?:Initiative|Projekt|Netzwerk)\b", "Initiative / project"),
]
NONPROFIT_FORMS = ["gGmbH", "gUG"]
PROFIT_FORMS = ["AG", "Ltd", "Limited", "Inc", "LLC", "GmbH", "GmbH & Co. KG", "UG", "UG (haftungsbeschränkt)", "GbR", "KG", "OHG"]
NONPROFIT_WORDS = r"\b(?:gemeinn[üu]tzig|non-profit|nonprofit|not-for-profit|charitable\s+organisation?|charitable\s+organization|tax.exempt\s+charitable|wohlt[äa]tig)\b"

# Search scoring: words without signal.
STOPWORDS = ["the", "and", "for", "with", "von", "van", "de", "der", "die", "das", "und", "fur", "gmbh", "ag", "ev", "mbh", "inc", "ltd", "llc"]

# E-mail addresses of examples and robots.
EXAMPLE_HOSTS = ["example.com", "example.org", "example.net", "domain.com", "yourdomain.com", "mustermann.de", "yourcompany.com"]
ROBOT_LOCALS = ["noreply", "no-reply", "donotreply", "do-not-reply"]

# Patterns that must read exactly so for equal results: e-mail and web addresses and telephones in cells of contacts.
EMAIL = r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
URL = r"(?:https?://|www\.)[^\s,;|]+|\b(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?::[0-9]+)?(?:/[^\s,;|]*)?"
PHONE = r"(?<!\w)\+?\d[\d\s()./-]{6,}\d"
# The same for web pages: e-mail addresses, also written out, and postal addresses with street, number, postcode and town.
PAGE_EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
WRITTEN_AT = r"(?:\(at\)|\[at\]|\bat\b)"
WRITTEN_DOT = r"(?:\(dot\)|\[dot\]|\bdot\b)"
WRITTEN_EMAIL = rf"[a-zA-Z0-9._%+\-]+\s*{WRITTEN_AT}\s*[a-zA-Z0-9.\-]+\s*{WRITTEN_DOT}\s*[a-zA-Z]{{2,}}"
STREET_ENDINGS = ["straße", "strasse", r"str\.", "weg", "gasse", "platz", "allee", "ring", "damm", "ufer", "steig", "berg"]
PAGE_STREET_ENDINGS = [*STREET_ENDINGS, "chaussee"]
PAGE_STREET = rf"[A-ZÄÖÜ][a-zA-ZäöüÄÖÜß\-.]{{1,30}}(?:\s+[A-ZÄÖÜ][a-zA-ZäöüÄÖÜß\-.]{{1,30}}){{0,3}}\s*(?:{'|'.join(PAGE_STREET_ENDINGS)})\.?"
PAGE_NUMBER = r"\s*\d{1,4}\s*[a-zA-Z]?(?:\s*/\s*\d{1,4}\s*[a-zA-Z]?)?"
PAGE_TOWN = r"[A-ZÄÖÜ][a-zA-ZäöüÄÖÜß\-]{1,30}(?:\s+[A-ZÄÖÜ][a-zA-ZäöüÄÖÜß\-]{1,30}){0,2}"
PAGE_ADDRESS = rf"({PAGE_STREET})({PAGE_NUMBER})[,\n\r]?\s*(\d{{5}})\s+({PAGE_TOWN})"
WORDS_AFTER_TOWN = r"(?:Telefon|Tel\.?|Phone|E-?Mail|Fax)\b"
# Words before a name on an Impressum page; characters of the page that are searched.
IMPRESSUM_LABELS = ["anbieter", "betreiber", "inhaltlich verantwortlich"]
IMPRESSUM_CHARACTERS = 1500

# Column orders.
CONTACT_COLUMNS = [
    "ID", "Email_Domain", "Website", "Organisation_Name", "Email", "Contact_Name", "Email_Alternatives", "Phone", "Phone_Alternatives", "Website_Alternatives", "LinkedIn", "Role",
    "Organisation_Type", "Sector", "Location", "Address", "Description", "Responsible_Person", "Source_File", "Source_Row",
]
ENRICHED_COLUMNS = [
    "ID", "Email_Domain", "Email_Domain_Source", "Website", "Website_Normalized", "Website_Response_Code", "Website_Response_Text", "Website_Source", "Organisation_Name",
    "Organisation_Name_Source", "Organisation_Type", "Organisation_Type_Source", "Organisation_Legal_Form", "Organisation_Legal_Form_Source", "Organisation_Nonprofit_Status",
    "Organisation_Nonprofit_Source", "Email", "Email_Source", "Email_Alternatives", "Address", "Address_Source", "Address_Alternatives", "Contact_Name", "Contact_Name_First_Name",
    "Contact_Name_Last_Name", "Contact_Name_Source",
]
ORGANISATION_COLUMNS = [
    "Organisation_Name", "Organisation_Name_Source", "Organisation_Type", "Organisation_Type_Source", "Organisation_Legal_Form", "Organisation_Legal_Form_Source",
    "Organisation_Nonprofit_Status", "Organisation_Nonprofit_Source", "Website", "Website_Normalized", "Website_Source", "Website_Response_Code", "Website_Response_Text",
    "Email_Domain", "Address", "Address_Source", "Address_Alternatives",
]
