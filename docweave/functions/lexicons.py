"""Default lexicons and policy constants. Every operator takes them as parameters; these are the domain's own."""

# The lists below must equal the published ones for results to agree, in this order.

CORE = {
    "structural engineering": 0.20, "structural consultancy": 0.25, "structural design": 0.20, "structural designs": 0.20, "structural analysis": 0.18,
    "proof checking": 0.22, "peer review": 0.18, "structural audit": 0.20, "retrofit": 0.18, "retrofitting": 0.18, "rehabilitation": 0.18,
    "structural health monitoring": 0.20, "warehouse": 0.12, "logistics park": 0.12, "fulfillment center": 0.12, "industrial building": 0.12,
    "industrial shed": 0.10, "high rise": 0.10, "high-rise": 0.10, "commercial tower": 0.12, "residential tower": 0.10, "rcc": 0.08,
    "steel structure": 0.10, "pre engineered building": 0.10, "pre-engineered building": 0.10, "peb": 0.08,
}
SECONDARY = {"industrial": 0.05, "commercial": 0.05, "structural": 0.08, "warehouse": 0.05, "building": 0.04, "tower": 0.04, "logistics": 0.05}
PROCUREMENT = [
    "tender", "rfp", "request for proposal", "expression of interest", "eoi", "bid", "empanelment", "consultancy services", "notice inviting tender",
    "invitation for bids", "invitation to tender", "selection of consultant", "selection of consultants", "appointment of consultant", "appointment of consultants",
]
SERVICE = [
    "consultancy services", "structural consultant", "structural consultancy", "structural engineering consultancy", "structural design consultancy",
    "structural engineer", "structural engineering", "proof checking", "structural audit", "peer review", "retrofit", "retrofitting", "rehabilitation",
    "design and drawings", "architectural and structural", "structural assessment", "structural inspection", "structural safety audit",
    "building condition assessment", "structural health assessment", "design verification",
]
REGION_BOOST = {
    "delhi": 0.10, "new delhi": 0.10, "ncr": 0.10, "noida": 0.10, "greater noida": 0.10, "ghaziabad": 0.10, "gurgaon": 0.10, "gurugram": 0.10,
    "faridabad": 0.08, "uttar pradesh": 0.05, "haryana": 0.05, "punjab": 0.05,
}
REGION_PENALTY = {
    "kerala": 0.06, "tamil nadu": 0.05, "andhra pradesh": 0.05, "telangana": 0.05, "karnataka": 0.05, "maharashtra": 0.04, "gujarat": 0.04,
    "rajasthan": 0.03, "west bengal": 0.04, "odisha": 0.04, "assam": 0.05, "bihar": 0.04, "jharkhand": 0.04, "chhattisgarh": 0.04,
    "madhya pradesh": 0.04, "uttarakhand": 0.03, "goa": 0.04, "jammu and kashmir": 0.05, "ladakh": 0.05,
}
NEGATIVE = {
    "road": 0.05, "roads": 0.05, "bridge": 0.03, "bridges": 0.03, "highway": 0.08, "highways": 0.08, "expressway": 0.08, "greenfield corridor": 0.08,
    "railway": 0.05, "airport": 0.04, "electrical maintenance": 0.12, "housekeeping": 0.20, "sanitation": 0.20, "sweeping": 0.20, "survey only": 0.15,
    "dpr only": 0.15, "manpower supply": 0.20, "security services": 0.20, "vehicle hiring": 0.20, "transportation services": 0.20, "catering services": 0.20,
}
ORGANIZATIONS = {"cpwd": 0.06, "nbcc": 0.06, "dmrc": 0.06, "iit": 0.05, "aiims": 0.05, "municipal corporation": 0.04, "smart city": 0.04, "development authority": 0.04}
SOURCES = {"etenders.gov.in": 0.05, "gem.gov.in": 0.05, "eprocure.gov.in": 0.05, "gov.in": 0.03}
TITLE_TERMS = [
    "consultant", "consultancy", "structural", "proof checking", "empanelment", "rfp", "eoi", "retrofit", "retrofitting", "audit", "peer review",
    "structural engineering", "structural design", "structural assessment",
]
BLOCKED = [
    "road", "highway", "NH-", "national highway", "bridge", "flyover", "expressway", "overpass", "underpass", "grade separator", "bituminous", "pavement",
    "carriageway", "PMGSY", "NHAI", "MoRTH", "rail", "airport", "port", "dam", "irrigation", "canal", "water supply", "sewage", "drainage", "pipeline",
    "power transmission", "solar plant", "wind energy", "transmission line",
]
BLOCK_EXEMPT = ["road", "expressway"]

ROUTER_TENDER = [
    "tender", "tenders", "rfp", "request for proposal", "rfq", "request for quotation", "eoi", "expression of interest", "empanelment", "bid", "bidding",
    "corrigendum", "invitation for bids", "notice inviting tender",
]
ROUTER_STRONG = [
    "structural engineering", "structural consultancy", "structural consultant", "structural consultants", "structural engineer", "structural engineers",
    "structural design", "structural analysis", "proof checking", "proof check", "peer review", "structural audit", "retrofit", "retrofitting",
    "rehabilitation", "structural health monitoring", "design and drawings", "structural drawings", "civil structural", "rcc design", "steel structure",
    "steel structures", "pre-engineered building", "pre engineered building", "peb structure", "peb structures", "industrial structure",
    "industrial structures", "industrial shed", "industrial sheds", "warehouse", "warehouses", "logistics park", "logistics hub", "high-rise", "high rise",
    "residential tower", "residential towers", "commercial tower", "commercial towers", "third party inspection", "structural assessment",
    "condition survey", "due diligence", "forensic engineering", "value engineering", "independent engineer", "owner's engineer", "owners engineer",
    "detailed engineering", "design review", "authority engineer", "bridge inspection", "seismic evaluation", "vulnerability assessment", "rehabilitation design",
]
ROUTER_CONSULTANCY = [
    "consultant", "consultants", "consultancy", "consultancy services", "engineering services", "design services", "structural services", "proof checking",
    "peer review", "structural audit", "empanelment of consultants", "empanelment of consultant", "selection of consultant", "selection of consultants",
    "appointment of consultant", "appointment of consultants", "technical consultancy",
]
ROUTER_UNRELATED = [
    "landscaping", "landscape maintenance", "tree cutting", "tree plantation", "gardening", "horticulture", "demolition", "demolition work",
    "hvac maintenance", "air conditioning maintenance", "housekeeping", "sanitation", "sweeping", "cleaning services", "janitorial", "restaurant",
    "catering", "food services", "security services", "manpower supply", "electrical maintenance", "facility management", "pest control",
]
ROUTER_BAD_URLS = ["/category/", "/categories/", "/search", "/tag/", "/tags/", "page=", "/login", "/signin", "/sign-in"]
ROUTER_URL_HINTS = ["/tender", "/tenders", "/procurement", "/rfp", "/eoi", "/bid", "/bids", "/empanelment", "/notice"]
TRACKING = ["fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "ref", "ref_src", "igshid", "spm"]

SEARCH_BAD_TITLES = [
    "latest tenders", "tenders in india", "search tenders", "keyword tenders", "government tenders", "all tenders", "tender listings",
    "latest active tenders", "online tenders", "directory", "top tenders", "eprocurement system", "award of contract", "award notice", "contract awarded",
    "corrigendum", "corrigenda", "results", "result", "archive", "archived", "cancelled", "cancellation", "application form", "registration form", "vendor registration",
]
SEARCH_BAD_DOMAINS = [
    "bidassist.com", "tendersontime.com", "tender247.com", "tenderdetail.com", "tendersinfo.com", "tendernews.com", "tenderbazaar.com", "tendersniper.com",
    "nationaltenders.com", "firsttender.com", "globaltenders.com", "maharashtratenders.com", "delhitenders.com", "justdial.com", "indiamart.com", "sulekha.com", "scribd.com",
]
OFFICIAL_DOMAINS = ["gov.in", "nic.in", "etenders.gov.in", "eprocure.gov.in", "gem.gov.in", "cppp.gov.in"]
SEARCH_POSITIVE = [
    "structural", "structural consultant", "structural consultancy", "structural engineering", "proof checking", "peer review", "structural audit",
    "rehabilitation", "retrofit", "consultancy", "consultant", "rfp", "eoi", "expression of interest", "empanelment", "request for proposal", "tender",
]
SEARCH_NEGATIVE = [
    "housekeeping", "landscaping", "tree cutting", "demolition", "canteen", "cafeteria", "restaurant", "electrical maintenance", "annual maintenance", "amc",
    "road", "roads", "bridge", "bridges", "highway", "railway", "airport", "drain", "drainage", "water supply", "pipeline",
]
SEARCH_URL_HINTS = ["tender", "rfp", "eoi", "empanelment", "consultancy", "procurement", "bid"]
SEARCH_BAD_PATHS = ["/archive", "/award", "/result", "/results", "/blog", "/news", "/category", "/categories", "/tag", "/tags", "/search"]

STRUCTURAL = [
    "structural consultant", "structural consultants", "structural consultancy", "structural engineering", "structural engineer", "structural engineers",
    "structural design", "structural analysis", "structural services", "structural drawings", "proof checking", "proof check", "structural audit",
    "condition assessment", "condition survey", "structural assessment", "structural health monitoring", "peer review", "design verification",
    "design review", "retrofit", "retrofitting", "rehabilitation", "strengthening", "rcc", "rcc design", "steel structure", "steel structures", "warehouse",
    "warehouses", "logistics park", "logistics hub", "industrial building", "industrial structure", "industrial shed", "peb", "pre engineered building", "pre-engineered building",
]
CONTEXT_DEPENDENT = ["retrofit", "retrofitting", "rehabilitation", "strengthening", "warehouse", "warehouses", "rcc", "peb"]
STRUCTURAL_CONTEXT = [
    "structural", "structure", "structures", "building", "buildings", "rcc", "reinforced concrete", "concrete structure", "steel structure",
    "steel structures", "beam", "beams", "column", "columns", "slab", "slabs", "foundation", "foundations", "framing", "structural drawing",
    "structural drawings", "structural design", "structural analysis", "structural engineering", "civil structural", "load bearing", "load-bearing", "seismic", "earthquake",
]
OTHER_RETROFIT = [
    "hvac", "chiller", "chillers", "cooling tower", "cooling towers", "vfd", "variable frequency drive", "air conditioning", "air-conditioning",
    "electrical panel", "electrical panels", "electrical equipment", "electrical system", "electrical systems", "transformer", "transformers", "switchgear",
    "cable", "cables", "plumbing", "fire fighting system", "firefighting system", "mechanical equipment", "mechanical system", "mechanical systems", "lift",
    "lifts", "elevator", "elevators",
]
INTELLIGENCE_NEGATIVE = [
    "road", "roads", "highway", "highways", "expressway", "expressways", "bridge", "bridges", "airport", "airports", "railway", "railways", "rail",
    "flyover", "overpass", "underpass", "port", "ports", "dam", "dams", "irrigation", "canal", "canals", "water supply", "sewage", "drainage", "pipeline",
    "pipelines", "power transmission", "transmission line", "solar plant", "wind energy", "housekeeping", "sanitation", "sweeping", "cleaning services",
    "janitorial", "security services", "manpower supply", "landscaping", "landscape maintenance", "tree cutting", "tree plantation", "gardening",
    "horticulture", "restaurant", "catering", "food services", "pest control", "facility management",
]
DIRECTORY = [
    "top 10", "top 20", "top 50", "top 100", "best structural consultants", "best structural consultant", "list of structural consultants",
    "list of structural engineers", "directory", "directories", "listing", "listings", "find a consultant", "find consultants", "consultants in",
    "consultant in", "consultants near", "consultant near", "companies in", "firms in", "service providers", "business directory", "review", "reviews",
    "rating", "ratings", "rankings", "profile", "profiles",
]
DIRECTORY_URLS = ["/directory", "/directories", "/listing", "/listings", "/reviews", "/rating", "/ratings", "/top-", "/best-"]
TENDER_SIGNALS = [
    "tender", "tenders", "rfp", "request for proposal", "rfq", "request for quotation", "eoi", "expression of interest", "empanelment", "bid", "bidding",
    "invitation for bids", "notice inviting tender", "nit", "procurement", "appointment", "selection of consultant", "selection of consultants",
    "engagement of consultant", "engagement of consultants",
]
TENDER_URLS = ["/tender", "/tenders", "/procurement", "/rfp", "/rfq", "/eoi", "/bid", "/bids", "/empanelment", "/notice", "/nit"]
INFORMATIONAL = [
    "top 10", "top 5", "top 20", "top 50", "directory", "list of consultants", "list of structural consultants", "consultant listing",
    "consultants listing", "find consultants", "best structural consultants", "best consultants",
]
DEFAULT_CATEGORY = "general structural consultancy"
CATEGORIES = {
    "structural audit": ["structural audit", "building audit", "condition assessment", "condition survey", "structural assessment", "structural health monitoring", "structural health assessment"],
    "proof checking": ["proof checking", "proof check", "proof consultant", "design verification", "design review", "independent design review"],
    "retrofit consultancy": [
        "structural retrofit", "structural retrofitting", "retrofitting of structure", "retrofitting of building", "building retrofit",
        "building retrofitting", "rehabilitation of structure", "rehabilitation of building", "structural rehabilitation", "structural strengthening",
        "strengthening of structure", "strengthening of building", "rcc strengthening", "rcc retrofitting",
    ],
    "peb design": ["peb", "peb structure", "peb structures", "pre engineered building", "pre-engineered building", "pre engineered buildings", "pre-engineered buildings"],
    "warehouse": ["warehouse", "warehouses", "logistics park", "logistics parks", "logistics hub", "distribution center", "distribution centre", "storage facility"],
    "industrial building": [
        "industrial building", "industrial buildings", "factory building", "factory buildings", "plant building", "plant buildings",
        "industrial structure", "industrial structures", "industrial shed", "industrial sheds",
    ],
    "structural consultancy": [
        "structural consultant", "structural consultants", "structural consultancy", "structural engineering", "structural engineer",
        "structural engineers", "structural design", "structural analysis", "structural services", "civil structural", "structural drawings",
        "structural drawing", "structural design services", "structural engineering services",
    ],
}

GENERIC_TITLES = ["request for proposal", "rfp", "tender", "expression of interest", "document for eoi", "application form", "tender document", "bid document"]
JUNK_TITLES = ["home page", "sign in", "login", "privacy policy", "cookie"]
REFERENCE_PHRASES = [
    "application form", "application for empanelment", "application for registration", "registration form", "enrolment form", "enrollment form",
    "list of empanelled consultants", "list of empaneled consultants", "list of approved consultants", "building safety certificate",
    "certificate of structural safety", "format for application", "form for application",
]
ACTIVE_PHRASES = [
    "notice inviting tender", "invites applications", "invitation for bids", "request for proposal", "request for quotation", "expression of interest",
    "eoi", "empanelment of", "selection of consultant", "selection of consultants", "appointment of consultant", "appointment of consultants",
    "consultancy services", "tender for", "bid for", "invitation to tender", "appointment of structural consultant",
    "appointment of structural consultants", "selection of structural consultant", "selection of structural consultants",
    "engagement of structural consultant", "engagement of structural consultants", "invitation for structural consultant",
    "invitation for structural consultants", "empanelment of structural consultant", "empanelment of structural consultants",
]
SUSPICIOUS_LOCATIONS = ["http://", "https://", "www.", "proposal may be", "registration no.", "tax department", "service tax"]
PURSUE = ["structural consultancy", "structural audit", "proof checking", "retrofit consultancy"]
REVIEW = ["industrial building", "warehouse", "peb design"]
SUFFIXES = ["", "tender", "RFP", "EOI", "empanelment", "consultancy services", "government tender", "eprocurement"]
STORE_COLUMNS = [
    "Opportunity_ID", "Type", "Title", "Organization", "Service_Category", "Location", "Source", "Source_Link", "Deadline", "Contact_Status",
    "Opportunity_Status", "Priority", "Score", "Qualified", "Qualification_Score", "Recommended_Action", "Qualification_Reasoning", "Summary",
    "Assigned_To", "Last_Updated", "Date_Added",
]

# The regular expressions of the rules, here and below.
ERROR_PATTERNS = [
    r"\b404\b", r"\b403\b", r"\b500\b", r"page\s+not\s+found", r"access\s+denied", r"forbidden", r"internal\s+server\s+error", r"service\s+unavailable",
    r"bad\s+gateway", r"website\s+under\s+maintenance", r"site\s+under\s+maintenance", r"verify\s+you\s+are\s+human", r"captcha", r"cloudflare",
    r"javascript\s+required", r"please\s+enable\s+javascript", r"cookies\s+required",
]
NAVIGATION_LINES = [
    "home", "about", "about us", "contact", "contact us", "login", "log in", "sign in", "register", "sign up", "search", "advanced search", "site map",
    "sitemap", "skip to content", "skip navigation", "accessibility", "help", "feedback", "quick links", "quick link", "navigation", "menu", "back", "next", "previous",
]
BOILERPLATE_PATTERNS = [
    r"privacy\s+policy", r"terms\s+of\s+use", r"terms\s+and\s+conditions", r"all\s+rights\s+reserved", r"copyright", r"powered\s+by", r"visitor\s+counter",
    r"last\s+updated", r"screen\s+reader", r"accessibility\s+statement",
]
COOKIE_PATTERNS = [r"cookie\s+policy", r"accept\s+cookies", r"allow\s+cookies", r"we\s+use\s+cookies", r"manage\s+cookies"]
SCRIPT_PATTERNS = [r"enable\s+javascript", r"javascript\s+disabled", r"javascript\s+required", r"browser\s+not\s+supported", r"please\s+wait", r"loading\.\.\."]
PAGE_NUMBERS = [r"page\s+\d+", r"page\s+\d+\s+of\s+\d+", r"\d+\s*/\s*\d+", r"-+\s*\d+\s*-+"]
CONTENTS_LINES = [r"table\s+of\s+contents", r"contents", r"index", r".+\.{3,}\s*\d+"]
PROTECTED_HEADINGS = [
    "scope of work", "scope", "eligibility", "eligibility criteria", "emd", "earnest money", "tender fee", "document fee", "technical bid",
    "financial bid", "important dates", "critical dates", "qualification", "schedule", "annexure", "appendix", "description", "project description", "contact details",
]

REQUIRED_TERMS = ["tender", "rfp", "request for proposal", "eoi", "expression of interest", "bid", "consultancy", "empanelment", "submission", "technical bid", "financial bid", "scope of work"]
STRONG_BAD_PAGE = ["page not found", "access denied", "forbidden", "captcha"]
CONTEXT_BAD_PAGE = ["home page", "search results"]
BLOCKED_PAGE = [
    "404", "access denied", "forbidden", "page not found", "javascript required", "captcha", "verify you're human", "verify you are human", "cloudflare",
    "security check", "attention required", "checking your browser",
]
NOISE_WORDS = ["home", "login", "sign in", "search", "privacy policy", "copyright", "all rights reserved"]
PAGE_TERMS = ["tender", "bid", "proposal", "consultancy", "scope of work", "deadline", "emd", "corrigendum", "rfp", "eoi"]
NAVIGATION_HEAVY = ["home", "contact us", "about us", "login", "sign in", "search", "sitemap", "downloads", "archive", "circulars", "recruitment", "latest news"]
LOGIN_SIGNS = ["login", "sign in", "session expired", "access denied", "unauthorized", "user authentication", "password"]
CAPTCHA_SIGNS = ["captcha", "verify you are human", "verify you're human", "cloudflare", "incapsula", "bot detection", "security check", "human verification"]
SUPPORTED_TYPES = ["text/html", "application/pdf", "application/xhtml+xml", "application/xml", "text/xml", "application/octet-stream"]
UNSUPPORTED_TYPES = [
    "image/", "video/", "audio/", "application/zip", "application/x-rar", "application/x-7z", "application/x-msdownload", "application/x-executable",
    "application/vnd.android.package-archive",
]
REMOVED_TAGS = ["script", "style", "noscript", "svg", "canvas", "iframe", "template", "dialog"]
LAYOUT_TAGS = ["header", "footer", "nav", "aside"]
LAYOUT_NAMES = [
    "nav", "navbar", "navigation", "menu", "sidebar", "footer", "header", "breadcrumb", "breadcrumbs", "social", "share", "cookie", "advert", "ads",
    "banner", "topbar", "top-bar", "toolbar", "masthead", "quicklinks", "quick-links", "leftmenu", "rightmenu", "left-nav", "right-nav", "announcement",
    "accessibility", "skip-link", "language", "search-box", "searchbar", "pagination", "related", "newsletter", "login", "signin", "signup", "popup",
    "modal", "overlay", "floating", "cookie-consent", "consent", "consent-banner", "gdpr", "privacy-banner", "accept-cookie", "acceptcookies", "cookiebanner",
]
CONTENT_NAMES = ["content", "page-content", "main-content", "maincontent", "container", "article", "tender", "document"]
HIDDEN_STYLES = [
    "display:none", "display: none", "visibility:hidden", "visibility: hidden", "opacity:0", "opacity: 0", "opacity:0.0", "height:0px", "height: 0px",
    "width:0px", "width: 0px",
]

CRAWL_NAVIGATION = [
    "tender", "tenders", "procurement", "eprocurement", "e-procurement", "e-tender", "etender", "e-tendering", "bid", "bids", "bidding", "bid invitation",
    "rfp", "rfq", "eoi", "expression of interest", "notice inviting tender", "invitation for bids", "invitation to bid", "request for proposal",
    "request for quotation", "consultancy", "consultant", "empanelment", "notices", "procurement notice", "business opportunities", "vendor", "contracts",
]
CRAWL_TENDER = [
    "tender", "tenders", "rfp", "rfq", "eoi", "expression of interest", "notice inviting tender", "invitation for bids", "invitation to bid",
    "request for proposal", "request for quotation", "bid invitation", "bidding", "empanelment", "consultant", "consultancy", "structural",
    "structural consultant", "structural consultancy", "structural engineer", "structural engineering", "structural audit", "proof checking", "peer review",
    "retrofitting", "rehabilitation", "design consultant", "engineering consultant",
]
CRAWL_BAD_LINKS = [
    "login", "signin", "sign-in", "register", "registration", "contact", "privacy", "terms", "about", "career", "careers", "recruitment", "vacancy", "jobs",
    "apprentice", "apprenticeship", "news", "gallery", "facebook", "twitter", "linkedin", "youtube", "instagram", "vendor-registration",
    "vendor_registration", "vendorregistration", "buyer-registration", "buyer_registration", "buyerregistration", "bidder-registration",
    "bidder_registration", "bidderregistration", "bidder-login", "buyer-login", "bid-result", "bidresult", "bid-result-list", "bidresultlists",
    "result-list", "results", "statistics", "statistic", "dashboard", "reports", "report", "analytics", "archive", "archived", "sitemap", "slideshare",
    "investor", "investors", "shareholder", "annual-report", "annualreport", "financial-results", "financial-result", "stock-exchange", "corporate",
    "press-release", "pressrelease", "media", "events", "event", "pay", "citizen",
]
CRAWL_BAD_QUERIES = ["order_by=", "sort=", "orderby=", "sortby=", "page=", "pageno=", "page_no=", "offset=", "limit=", "filter=", "filterby=", "search=", "keyword=", "orderby"]
CRAWL_BAD_TITLES = [
    "buyer registration", "bidder registration", "vendor registration", "vendor login", "buyer login", "bidder login", "ongoing bids", "bid/ra status",
    "bid status", "bid result", "bid results", "list of bids", "procurement data", "procurement statistics", "procurement report", "dashboard", "login",
    "registration", "contact us", "about us", "career", "careers", "recruitment", "apprentice", "apprenticeship", "privacy policy", "terms and conditions",
    "organisation name", "organization name", "tender opening date", "bid submission closing date", "e-published date", "title/ref.no./tender id",
    "corrigendum", "download", "details", "click here",
]
CRAWL_STRONG = [
    "structural", "structural consultant", "structural consultancy", "structural engineer", "structural engineering", "structural design",
    "structural analysis", "structural audit", "proof checking", "proof check", "peer review", "retrofitting", "rehabilitation", "engineering consultant",
    "engineering consultancy", "design consultant",
]
CRAWL_EVIDENCE = [
    "tender id", "tender no", "tender number", "tender ref", "reference no", "ref no", "notice no", "notice number", "bid no", "bid number",
    "bid reference", "submission date", "submission deadline", "bid submission", "closing date", "closing time", "last date", "last date for submission",
    "due date", "opening date", "tender opening", "bid opening", "estimated cost", "emd", "earnest money", "document fee", "scope of work",
    "scope of services", "terms of reference", "tor", "invitation",
]
GENERIC_ANCHORS = ["view", "details", "detail", "click here", "click", "download", "more", "read more", "open", "document", "view details", "view document", "download document"]
DOCUMENT_TYPES = [".pdf", ".doc", ".docx", ".xls", ".xlsx"]
GOVERNMENT_DOMAINS = [".gov.in", ".nic.in", "eprocure.gov.in", "etenders.gov.in", "gem.gov.in", "ireps.gov.in", "coalindiatenders.nic.in"]
LINK_PDF = [".pdf", "download", "document", "nit", "tendernotice", "tender_notice", "notice", "rfp", "eoi", "bid", "empanelment", "corrigendum"]
LINK_TENDER = [
    "tender", "rfp", "eoi", "bid", "corrigendum", "notice", "empanelment", "expression of interest", "request for proposal", "consultant", "consultancy",
    "structural", "architectural", "engineering", "proof checking", "structural audit",
]
LINK_IRRELEVANT = [
    "act", "rules", "policy", "policies", "annual report", "brochure", "handbook", "manual", "guidelines", "notification", "circular", "budget", "order",
    "government order", "privacy", "terms", "publication", "magazine", "newsletter", "calendar", "recruitment", "admission", "prospectus",
]
LINK_SCHEMES = ["javascript:", "mailto:", "tel:", "#"]
MESSAGING = ["wa.me", "api.whatsapp.com", "web.whatsapp.com"]
NAVIGATION_PATHS = ["/searchresult/", "/search/", "/pages/download-tender-mobile-app"]

GENERIC_HEADINGS = [
    r"request\s+for\s+proposal[s]?", r"request\s+for\s+quotation[s]?", r"request\s+for\s+bid[s]?", r"request\s+for\s+expression\s+of\s+interest",
    r"expression\s+of\s+interest", r"eoi", r"rfp", r"rfq", r"nit", r"tender", r"tender\s+document", r"bid\s+document", r"bid\s+invitation",
    r"consultancy\s+services", r"consultant\s+services", r"empanelment", r"notice\s+inviting\s+tender[s]?", r"invitation\s+for\s+bids?",
    r"invitation\s+to\s+bid", r"request\s+for\s+selection",
]
TITLE_WORDS = [
    "request for proposal", "request for quotation", "request for bid", "expression of interest", "notice inviting tender", "invitation for bids", "tender",
    "consultancy", "consultant", "empanelment", "selection", "appointment", "design", "construction", "procurement", "supply", "execution", "maintenance",
    "operation", "engineering", "architectural", "structural", "project management", "pmc", "survey", "works", "services", "development", "renovation",
    "retrofitting", "rehabilitation", "proof checking", "peer review", "structural audit", "structural assessment", "structural design",
]
SECTION_HINTS = ["name of work", "scope of work", "brief scope", "project description", "tender description", "description of work"]
DESCRIPTION_HEADERS = ["scope of work", "brief scope", "project description", "tender description", "description of work", "name of work", "objective", "background", "about the project"]
ORGANIZATION_LABELS = [
    "organization", "organisation", "client", "department", "authority", "owner", "issued by", "employer", "procuring entity", "procuring authority",
    "implementing agency", "purchaser", "buyer", "office",
]
DEADLINE_WORDS = [
    "last date", "closing date", "closing time", "submission", "bid submission", "proposal submission", "offer submission", "due date", "deadline",
    "last date of submission", "bid due", "closing", "tender closing", "submission deadline", "last date for submission", "date of closing",
]
DATE_SHAPES = [
    r"\b\d{4}-\d{1,2}-\d{1,2}\b", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b", r"\b\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}\b", r"\b\d{1,2}-[A-Za-z]{3,9}-\d{4}\b",
    r"\b[A-Za-z]{3,9}\s+\d{1,2},\s*\d{4}\b", r"\b\d{1,2}\.[0-9]{1,2}\.\d{2,4}\b",
]
GAZETTEER = [
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh", "jharkhand", "karnataka",
    "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha", "punjab", "rajasthan", "sikkim", "tamil nadu",
    "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi", "new delhi", "jammu and kashmir", "ladakh", "andaman and nicobar",
    "chandigarh", "dadra and nagar haveli", "daman and diu", "lakshadweep", "puducherry",
]
LOCATION_LABELS = ["location", "place of work", "work location", "site", "project location", "district", "state", "city", "place of execution", "execution location", "project site", "station"]
TENDER_TYPES = {
    "request for proposal": "RFP", "rfp": "RFP", "request for quotation": "RFQ", "rfq": "RFQ", "expression of interest": "EOI", "eoi": "EOI",
    "notice inviting tender": "NIT", "nit": "NIT", "empanelment": "EMPANELMENT", "consultancy": "CONSULTANCY", "consultant": "CONSULTANCY",
    "auction": "AUCTION", "rate contract": "RATE CONTRACT", "limited tender": "LIMITED TENDER", "open tender": "OPEN TENDER",
}
MONEY = r"(?:₹|rs\.?|inr)\s*([0-9][0-9,]*(?:\.\d{1,2})?)(?:\s*/-)?"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"(?<!\d)(?:\+91[\s-]?[6-9]\d{9}|0\d{2,5}[\s-]?\d{6,8}|[6-9]\d{9})(?!\d)"
GOVERNMENT = [
    "government", "govt", "ministry", "department", "directorate", "authority", "municipal", "municipality", "corporation", "council", "board",
    "commission", "public works", "pwd", "development authority", "urban development authority", "state government", "central government",
    "government of india", "govt. of india", "indian government", "public sector", "psu", "autonomous body", "institute", "university", "iit", "nit",
]
INSTITUTIONS = [
    "indian institute of technology", "national institute of technology", "indian institute of management", "indian institute of science",
    "all india institute of medical sciences", "aiims", "central public works department", "cpwd", "state public works department",
    "public works department", "municipal corporation", "development authority", "housing board", "electricity board", "state government",
    "government of india", "ministry of", "directorate of", "institute of technology", "institute of management", "board of", "university",
]
EXPERIENCE = {
    "Delhi NCR": {"locations": ["Gurgaon", "Delhi", "Noida", "Faridabad", "Dwarka"], "project_types": ["High-rise residential", "Luxury apartments", "Structural consultancy", "Developer housing projects"], "clients": ["TULIP", "Eldeco", "MRG", "Zara Rossa"]},
    "Punjab": {"locations": ["Ludhiana", "Jalandhar", "Amritsar"], "project_types": ["Residential towers", "Warehouses", "Industrial sheds"], "clients": ["AGI Infra", "Flipkart ecosystem"]},
    "Haryana": {"locations": ["Jhajjar", "Manesar", "Gurgaon outskirts"], "project_types": ["Warehouses", "Logistics parks", "Industrial structures"], "clients": ["LOGOS", "AllCargo", "Amazon logistics"]},
    "Uttar Pradesh": {"locations": ["Lucknow", "Noida Extension", "Kanpur"], "project_types": ["Warehouses", "Industrial facilities"], "clients": ["Amazon"]},
}
LEGACY_PENALTIES = [(["maintenance"], 0.25), (["repair"], 0.15), (["airport"], 0.40), (["rail", "metro"], 0.35)]
