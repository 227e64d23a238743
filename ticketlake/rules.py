"""Fixed values.

Word lists, cut-offs, code maps and weights that define the results. They are data: the compilers in
``ticketlake.functions.cleanse`` turn them into ``when`` chains. Patterns are matched on folded
(lower-case, accent-free) text, first match wins.
"""

ACCENTS_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
ACCENTS_TO = "aaaaaaceeeeiiiinooooouuuuyy"

# ---- service desk ------------------------------------------------------------------------------
CLOSED_STATUS = ("closed", "solved", "5", "6")
RESOLVED_STATUS = ("closed", "6")
WAITING_STATUS = ("waiting", "4")
TICKET_TYPE = [("1", "incident"), ("2", "request")]
LEVEL_CUTS = [(">=", 5, "critical"), (">=", 4, "high"), (">=", 3, "medium"), (">=", 1, "low")]
LEVEL_ORDINAL = [("critical", 5), ("high", 4), ("medium", 3), ("low", 2)]
DESK_STATUS = [
    (("closed", "solved", "5", "6"), "closed"),
    (("waiting", "4"), "in_progress"),
    (("plan", "3"), "in_progress"),
    (("assign", "2"), "open"),
    (("new", "1"), "open"),
]
EXTERNAL_PRIORITY = [(("critical", "urgent"), "critical"), ("high", "high"), ("medium", "medium"), ("low", "low")]
CONTENT_BLANKS = ("-", "null")
FOLLOWUP_LITERALS = ("&gt;", "--", "&nbsp;", "<br />")
LOG_BLANKS = ("-",)
SYSTEM_ACCOUNTS = ("glpi", "post-only", "tech", "normal", "administrateur")
SERVICE_ACCOUNTS = ("hotlinedsic", "standard", "contact", "centre.documentation", "sgagadir", "waliagadir")
CATEGORY_TYPE = [
    (("reseau", "network"), "NETWORK"),
    (("materiel", "hardware"), "HARDWARE"),
    (("logiciel", "software"), "SOFTWARE"),
    (("securite", "security"), "SECURITY"),
    ("imprim", "PRINTER"),
    (("messagerie", "mail"), "MAIL"),
    ("vpn", "VPN"),
]
CATEGORY_DEPTH = [(">=", 4, "high"), (">=", 2, "medium"), (">=", 1, "low")]
ITEM_TYPE = [
    ("computer", "Computer"),
    ("phone", "Phone"),
    ("printer", "Printer"),
    ("monitor", "Monitor"),
    ("network", "Network"),
]
ASSET_VALUE_CUTS = [(">=", 5000, "critical"), (">=", 2000, "high"), (">=", 1000, "medium")]
USER_TYPE_CODE = [("HUMAN", 0), ("SERVICE", 1), ("SYSTEM", 2), ("TEST", 3)]

# ---- device designations -----------------------------------------------------------------------
GPU_JUNK = ("4", "5")
GPU_JUNK_PARTS = ("controleur", "basic render", "carte graphique vga standard", "microsoft basic render")
GPU_BRAND = [
    ("nvidia", "NVIDIA"),
    ("geforce", "NVIDIA"),
    ("quadro", "NVIDIA"),
    ("intel", "Intel"),
    ("amd", "AMD"),
    ("radeon", "AMD"),
    ("ati", "AMD"),
    ("matrox", "Matrox"),
]
GPU_TYPE = [
    ("intel", "integrated"),
    ("express chipset", "integrated"),
    ("xpress", "integrated"),
    ("microsoft", "virtual"),
    ("basic render", "virtual"),
]
RAM_TYPE = [
    ("ddr5", "DDR5"),
    ("ddr4", "DDR4"),
    ("ddr3", "DDR3"),
    ("ddr2", "DDR2"),
    ("ddr", "DDR"),
    ("sdram", "SDRAM"),
    ("rdram", "RDRAM"),
    ("flash", "FLASH"),
]
RAM_CAPACITY_CUTS = [(">=", 16, "enterprise"), (">=", 8, "high"), (">=", 4, "medium"), (">=", 1, "low")]
CPU_FAMILY = [
    ("i9", "i9"),
    ("i7", "i7"),
    ("i5", "i5"),
    ("i3", "i3"),
    ("xeon", "Xeon"),
    ("ryzen 9", "Ryzen9"),
    ("ryzen 7", "Ryzen7"),
    ("ryzen 5", "Ryzen5"),
    ("ryzen 3", "Ryzen3"),
    ("pentium", "Pentium"),
    ("atom", "Atom"),
    ("core(tm)2 duo", "Core2Duo"),
]
CPU_ARCH = [("x64", "x64"), ("64-bit", "x64"), ("x86", "x86")]
CPU_CORES = [
    ("[1 core", 1),
    ("[2 core", 2),
    ("[4 core", 4),
    ("[6 core", 6),
    ("[8 core", 8),
    ("[12 core", 12),
    ("[16 core", 16),
]
CPU_PERFORMANCE = [
    (("i9", "i7", "Xeon", "Ryzen9", "Ryzen7"), "high"),
    (("i5", "Ryzen5", "Core2Duo"), "medium"),
    (("i3", "Ryzen3", "Pentium", "Atom"), "low"),
]

# ---- inventory ---------------------------------------------------------------------------------
BIOS_SERIAL_BLANKS = ("oem_serial", "system serial number", "12345678")
DEVICE_TYPE = [
    ("desktop", "desktop"),
    ("notebook", "laptop"),
    ("portable", "laptop"),
    ("optiplex", "desktop"),
    ("tower", "desktop"),
    ("mini", "desktop"),
    ("laptop", "laptop"),
    ("server", "server"),
]
ASSET_TAG_PARTS = ("no asset", "o.e.m")
VENDOR_GROUP = [
    ("hewlett", "HP"),
    ("compaq", "HP"),
    ("dell", "Dell"),
    ("lenovo", "Lenovo"),
    ("foxconn", "Foxconn"),
    ("micro-star", "MSI"),
]
BIOS_RISK_CUTS = [(">=", 10, "critical"), (">=", 5, "high"), (">=", 2, "medium"), ("<", 2, "low")]
RISK_ORDINAL = [("critical", 3), ("high", 2), ("medium", 1), ("low", 0)]
DRIVE_HEALTH_ORDINAL = [("critical", 3), ("high", 2), ("medium", 1), ("good", 0)]
DRIVE_TYPE = [
    ("fixed", "fixed"),
    ("local", "fixed"),
    ("removable", "removable"),
    ("usb", "usb"),
    ("network", "network"),
    ("cd", "cdrom"),
    ("dvd", "cdrom"),
]
DRIVE_USAGE_CUTS = [(">=", 0.90, "critical"), (">=", 0.75, "high"), (">=", 0.50, "medium"), ("<", 0.50, "healthy")]
LARGE_DRIVE = 500000
OS_FAMILY = [
    ("windows", "Windows"),
    ("linux", "Linux"),
    ("ubuntu", "Linux"),
    ("debian", "Linux"),
    ("mac", "MacOS"),
]
MEMORY_TIER_CUTS = [(">=", 16384, "high"), (">=", 8192, "medium"), (">=", 2048, "low")]
QUALITY_CUTS = [(">=", 90, "excellent"), (">=", 70, "good"), (">=", 50, "medium")]
ARCH_FAMILY = [(("x64", "amd64"), "64bit"), (("x86", "i386"), "32bit")]
MODULE_TYPE = [
    ("ddr5", "DDR5"),
    ("ddr4", "DDR4"),
    ("ddr3", "DDR3"),
    ("ddr2", "DDR2"),
    ("ddr", "DDR"),
    ("sdram", "SDRAM"),
]
MODULE_SPEED_CUTS = [(">=", 3200, "high"), (">=", 1600, "medium"), (">", 0, "low")]
MODULE_SERIAL_BLANKS = ("00000000", "sernum", "none")
MODULE_SIZE_CUTS = [(">=", 16, "high"), (">=", 8, "medium"), (">", 0, "low")]
NETWORK_TYPE = [
    ("ethernet", "ethernet"),
    ("wifi", "wifi"),
    ("wireless", "wifi"),
    ("bluetooth", "bluetooth"),
    ("loopback", "loopback"),
    ("vpn", "vpn"),
]
NETWORK_SPEED_CUTS = [(">=", 1000000000, "high"), (">=", 100000000, "medium"), (">", 0, "low")]
CONNECTION_STATUS = [(("up", "connected", "active"), "active"), (("down", "disconnected", "inactive"), "inactive")]
BITS_WIDTH = [("64", "64bit"), ("32", "32bit")]
SOFTWARE_CATEGORY = [
    ("office", "office"),
    (("chrome", "firefox", "edge"), "browser"),
    (("antivirus", "security", "defender"), "security"),
    (("sql", "mysql", "postgres"), "database"),
    (("java", "python", "visual studio"), "development"),
    (("vmware", "virtualbox"), "virtualization"),
]
SOFTWARE_RISK = [("java 6", "high"), ("flash", "high"), ("xp", "critical")]
STORAGE_VENDOR = [
    ("seagate", "Seagate"),
    (("western", "wd"), "Western Digital"),
    ("samsung", "Samsung"),
    ("toshiba", "Toshiba"),
    ("kingston", "Kingston"),
    ("intel", "Intel"),
]
STORAGE_TYPE_ANY = [("nvme", "NVMe"), ("ssd", "SSD"), ("hard disk", "HDD")]
STORAGE_TYPE_BUS = [("ata", "HDD"), ("sata", "HDD"), ("scsi", "HDD")]
STORAGE_SIZE_CUTS = [(">=", 1000000, "high"), (">=", 500000, "medium"), (">", 0, "low")]
STORAGE_SERIAL_BLANKS = ("00000000", "none", "unknown")
STORAGE_PERFORMANCE = [("nvme", "ultra"), ("ssd", "high"), ("sas", "medium"), ("hdd", "low")]

# ---- external data sets ------------------------------------------------------------------------
CVSS_CUTS = [(">=", 9, "critical"), (">=", 7, "high"), (">=", 4, "medium"), (">", 0, "low")]
LAPTOP_CPU = [
    ("i7", "i7"),
    ("i5", "i5"),
    ("i3", "i3"),
    ("ryzen 7", "ryzen7"),
    ("ryzen 5", "ryzen5"),
    ("celeron", "celeron"),
]
LAPTOP_GPU = [("nvidia", "NVIDIA"), ("amd", "AMD"), ("intel", "Intel")]
PRICE_CUTS = [(">=", 2000, "premium"), (">=", 1000, "mid_range"), (">", 0, "budget")]
EVENT_SEVERITY = [("error", "critical"), ("warning", "warning"), ("failure", "high"), ("audit", "audit")]
EVENT_SUSPICION = ("failed", "unauthorized", "denied")
EVENT_DOMAIN = [
    ("security", "security"),
    ("system", "system"),
    ("application", "application"),
    ("network", "network"),
]

# ---- unified layers ----------------------------------------------------------------------------
COMPLEXITY_CUTS = [(">=", 7, "complex"), (">=", 4, "moderate"), (">=", -1e18, "simple")]
AGE_SEVERITY_CUTS = [("<=", 4, "low"), ("<=", 24, "medium"), ("<=", 72, "high"), (">", 72, "critical")]
CUSTOMER_TYPE_CUTS = [(">=", 10, "frequent"), (">=", 5, "repeat"), (">=", 1, "returning")]
TRIAGE_CUTS = [(">=", 7, "critical"), (">=", 4, "high"), (">=", 2, "medium")]
ESCALATION_CUTS = [(">=", 7, "high"), (">=", 4, "medium")]
# rule score: column, ladder to 4/3/2, otherwise 1
RISK_COMPONENTS = [
    ("asset_age_years", [(">=", 10, 4), (">=", 5, 3), (">=", 2, 2)]),
    ("high_risk_software_count", [(">", 5, 4), (">", 2, 3), (">", 0, 2)]),
    ("drive_health_encoded", [(">=", 3, 4), ("=", 2, 3), ("=", 1, 2)]),
    ("bios_risk_encoded", [(">=", 3, 4), ("=", 2, 3), ("=", 1, 2)]),
    ("days_since_last_inventory", [(">=", 180, 4), (">=", 60, 3), (">=", 30, 2)]),
]
RISK_TIER_CUTS = [(">=", 18, "high"), (">=", 13, "medium"), (">=", 9, "low")]
FOLLOWUP_BUCKET_CUTS = [("<=", 0, 1), ("<=", 3, 2), ("<=", 10, 3), ("<=", 30, 4)]
RESOLUTION_TOKEN_CUTS = [
    (">", 168, "very_long_resolution"),
    (">", 72, "long_resolution"),
    (">", 24, "moderate_resolution"),
    (">", 0, "fast_resolution"),
]
STATUS_TOKEN = [
    (("5", "6"), "ticket_closed"),
    ("4", "ticket_pending"),
    ("3", "ticket_in_progress"),
    ("2", "ticket_assigned"),
    ("1", "ticket_new"),
]
OS_TOKEN = [("Windows", "windows_environment"), ("Linux", "linux_environment"), ("MacOS", "mac_environment")]
EMBEDDING_MODEL = "paraphrase-multilingual-MiniLM-L12-v2"

# ---- corpus and retrieval ----------------------------------------------------------------------
NOISE_PHRASES = (
    "best regards",
    "kind regards",
    "thanks regards",
    "thank you",
    "sent from my iphone",
    "please help",
    "dear support",
    "hello team",
    "hi team",
    "good morning",
    "good afternoon",
)
MIN_CHARS, MIN_WORDS, MAX_REPETITION = 20, 5, 0.60
CHUNK_SIZE, CHUNK_OVERLAP, MIN_CHUNK_WORDS = 256, 50, 5
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25
RRF_K = 60
# depth of each branch, of the fused list and of the reranked list in the second search service
BRANCH_K, HYBRID_K, RERANK_K = 60, 60, 10
CONTEXT_TOKENS = 4096
QUERY_EXPANSION = [
    ("not working", "not working failure error issue crashed down"),
    ("not connecting", "not connecting offline unreachable timeout network"),
    ("slow", "slow sluggish performance timeout latency delay"),
    ("error", "error failure exception issue problem"),
    ("crash", "crash failure freeze hang unresponsive"),
    ("access", "access login authentication permission credential"),
    ("SAP", "SAP system erp enterprise application"),
    ("VPN", "VPN remote access tunnel connection network"),
    ("email", "email mail outlook exchange communication"),
    ("password", "password credential login authentication security"),
    ("login", "login authentication access session credential"),
    ("network", "network connectivity connection internet"),
    ("server", "server backend host infrastructure service"),
    ("database", "database db sql data storage"),
    ("printer", "printer print printing device hardware"),
    ("update", "update upgrade patch version install"),
    ("install", "install setup deployment configuration installation"),
    ("permission", "permission access right authorization privilege"),
]
SYSTEM_PROMPT = (
    "You are an AI assistant for an IT Service Desk. "
    "Answer based ONLY on the provided context documents. "
    "Be specific, concise, and actionable. "
    "If the context does not contain enough information to answer, "
    "say that you do not have enough information rather than making up an answer."
)

# ---- triage ------------------------------------------------------------------------------------
TRIAGE_FEATURES = (
    "text_word_count",
    "text_char_count",
    "avg_word_length",
    "special_char_ratio",
    "text_complexity_score",
    "retrieval_quality_score",
    "corpus_quality_score",
    "similarity_confidence",
)
TRIAGE_TARGETS = ("priority_encoded", "urgency_encoded", "impact_encoded")
TRIAGE_NAMES = [("2", "Low"), ("3", "Medium"), ("4", "High"), ("5", "Critical")]
ESCALATION_WEIGHTS = {"priority": 0.5, "urgency": 0.3, "impact": 0.2}
ESCALATION_THRESHOLD = 0.6
TEXT_RISK_WEIGHTS = {
    "retrieval_quality_score": 0.4,
    "text_complexity_score": 0.3,
    "special_char_ratio": 0.2,
    "digit_ratio": 0.1,
}
SLA_MERGE_COLUMNS = (
    "was_sla_breached",
    "priority_score",
    "ticket_age_hours",
    "resolution_time_hours",
    "followup_count",
    "avg_followup_content_length",
    "issue_complexity_score",
    "customer_tenure_months",
    "previous_tickets",
)
MAX_NULL_PCT, MIN_VARIANCE = 99.0, 1e-8

# ---- request rates: prefix, requests, seconds --------------------------------------------------
RATE_RULES = [("/search", 20, 60), ("/auth/login", 5, 60), ("/register", 3, 300)]
RATE_DEFAULT = (100, 60)
