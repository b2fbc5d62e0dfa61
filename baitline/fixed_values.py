"""These must stay as they are for scores and reasons to come out right."""

# --- fixed values: indicator weights and levels -----------------------------------
WEIGHTS = {"text": 0.4, "url": 0.25, "sender": 0.2, "attachment": 0.15}
HIGH_FROM = 70.0
MEDIUM_FROM = 40.0
MAX_REASONS = 8

# --- fixed values: word lists ------------------------------------------------------
TEXT_KEYWORDS = [
    "urgent", "verify", "login", "reset", "suspended",
    "click below", "confirm", "invoice", "password", "account",
]
URL_KEYWORDS = ["verify", "urgent", "login", "reset", "invoice", "password"]
TRAINING_KEYWORDS = ["urgent", "verify", "login", "reset", "invoice", "password", "suspended"]

# --- fixed values: URL and feed tables ---------------------------------------------
SHORTENERS = ["bit.ly", "tinyurl.com", "t.co", "goo.gl", "ow.ly", "is.gd"]
UNCOMMON_TLDS = ["top", "xyz", "click", "work", "gq", "ml", "cf", "tk", "zip"]
DEFAULT_BAD_DOMAINS = ["example-phish.com", "secure-login-alert.net", "account-verify-now.top"]
DEFAULT_BAD_IPS = ["45.10.120.7", "185.234.218.12", "91.219.236.221"]

# --- fixed values: sender tables ---------------------------------------------------
BRANDS = [
    ("paypal", "paypal.com"),
    ("microsoft", "microsoft.com"),
    ("google", "google.com"),
    ("apple", "apple.com"),
    ("amazon", "amazon.com"),
    ("bank", None),
]
FREE_PROVIDERS = ["gmail.com", "outlook.com", "yahoo.com", "hotmail.com", "proton.me"]
TRAINING_FREE_PROVIDERS = ["gmail.com", "yahoo.com", "outlook.com"]

# --- fixed values: attachment extensions -------------------------------------------
EXECUTABLE_EXTENSIONS = ["exe", "scr", "bat", "cmd", "js", "vbs", "ps1", "msi", "com"]
MACRO_EXTENSIONS = ["docm", "xlsm", "pptm"]
ARCHIVE_EXTENSIONS = ["zip", "rar", "7z", "iso"]

# --- fixed values: points ----------------------------------------------------------
URL_POINTS = {
    "malformed": 5, "bad_ip": 35, "bad_domain": 35, "ip_host": 20, "subdomains": 12,
    "punycode": 18, "shortener": 14, "keyword": 8, "tld": 10, "long": 7,
}
URL_LONG_OVER = 120
URL_SUBDOMAINS_FROM = 3
SENDER_POINTS = {"invalid": 100, "digits": 8, "free": 6, "brand": 25}
ATTACHMENT_POINTS = {"executable": 30, "macro": 18, "archive": 12, "double": 25}
URL_THRESHOLD = 40.0

# --- fixed values: text model ------------------------------------------------------
CHUNK_CHARS = 1200
CHUNK_STEP = 900
KEYWORD_WEIGHT = 0.12
CAPS_WEIGHT = 1.5
EXCLAMATION_WEIGHT = 0.01
EXCLAMATION_LIMIT = 0.2
TEXT_STRONG_FROM = 0.65
TEXT_SOME_FROM = 0.35
SUBJECT_CHARS = 300
BODY_CHARS = 20000

# --- fixed values: reason texts ----------------------------------------------------
URL_REASONS = {
    "malformed": "Malformed URL detected: ",
    "bad_ip": "IP reputation feed flagged URL host: ",
    "bad_domain": "Domain reputation feed flagged URL host: ",
    "ip_host": "URL uses an IP address instead of a domain: ",
    "subdomains": "URL has excessive subdomains: ",
    "punycode": "Possible punycode domain detected: ",
    "shortener": "Shortened URL service used: ",
    "keyword": "Suspicious keyword found in URL: ",
    "tld": "Uncommon TLD found in URL: .",
    "long": "Very long URL detected",
}
SENDER_REASONS = {
    "invalid": "Invalid sender email format",
    "digits": "Sender domain contains unusual numeric pattern",
    "free": "Sender uses a free email provider",
    "brand": ("Sender name references ", " but email domain is "),
}
ATTACHMENT_REASONS = {
    "executable": "Executable-like attachment detected: ",
    "macro": "Macro-enabled document detected: ",
    "archive": "Archive attachment detected: ",
    "double": "Double extension pattern detected: ",
}
TEXT_REASONS = {
    "empty": "No text content found",
    "strong": "Email text uses high-pressure or credential-themed language",
    "some": "Email text includes some phishing-like wording",
    "model": "Transformer text model evaluated this content",
}
NO_REASON = "No high-confidence phishing indicators were triggered"
ACTIONS = {
    "high": "Do not click links or open attachments. Verify sender through a trusted channel.",
    "medium": "Proceed with caution and verify key details before taking action.",
    "low": "No major phishing signals detected, but remain cautious.",
}
POLICY_REASONS = {
    "block": " is blocklisted. Treat this as highly suspicious.",
    "allow": " is allow-listed. Analysis skipped.",
}
POLICY_ACTIONS = {
    "block": "Do not interact with this email.",
    "allow": "Sender is trusted by your local allow-list.",
}

# --- fixed values: alerts ----------------------------------------------------------
BADGES = {"high": ("HIGH", "#b83232"), "medium": ("MED", "#b7791f"), "low": ("LOW", "#2d7d46")}
ALERT_TITLE = " phishing risk detected"
ALERT_FALLBACK_SOURCE = "Current page"
ALERT_FALLBACK_REASON = "Potential phishing indicators detected."
ALERT_CHARS = 500
MIN_PAGE_CHARS = 80
PAGE_CHARS = 20000
PAGE_URLS = 80
UNKNOWN_HOST = "unknown.local"
FINGERPRINT_BODY_CHARS = 400
FINGERPRINT_CHARS = 120
DEBOUNCE_MS = 700

# --- fixed values: intake ----------------------------------------------------------
REQUIRED_FIELDS = ["sender_email", "subject", "body_text", "urls", "attachments"]
NOT_AN_OBJECT = "Payload must be a JSON object"

# --- fixed values: data sets -------------------------------------------------------
SEED = 42
SAMPLE_ROWS = 2000
ARCHIVE_LIMIT = 3000
MAIL_URLS = 20
MAIL_ATTACHMENTS = 10
EMPTY_BODY = "(empty body)"
BALANCED_ROWS = 300
VALIDATION_SHARE = 0.2
MAX_FEATURES = 12000
MAX_ITERATIONS = 1000
TOLERANCE = 1e-4
SAFE_DOMAINS = [
    "google.com", "youtube.com", "wikipedia.org", "github.com", "python.org",
    "apple.com", "microsoft.com", "amazon.com", "nytimes.com", "cnn.com",
    "openai.com", "mozilla.org", "stackoverflow.com", "cloudflare.com", "linkedin.com",
    "reddit.com", "bbc.com", "mit.edu", "stanford.edu", "who.int",
]
SAFE_PATHS = [
    "", "/", "/about", "/help", "/docs", "/blog", "/privacy", "/security", "/products", "/contact",
]
BENIGN_SENDERS = [
    ("noreply@github.com", "GitHub"),
    ("newsletter@python.org", "Python"),
    ("updates@openai.com", "OpenAI"),
    ("info@university.edu", "University Office"),
    ("news@nytimes.com", "NYTimes"),
]
BENIGN_SUBJECTS = [
    "Weekly newsletter",
    "Your account activity summary",
    "Meeting reminder",
    "Project update",
    "Security best practices",
]
BENIGN_BODIES = [
    "Here is your weekly update and upcoming events.",
    "We have updated documentation for your account settings.",
    "Reminder: your scheduled meeting is tomorrow at 10 AM.",
    "This message contains product release notes and changelog.",
    "Learn how to keep your account safe with these tips.",
]
BENIGN_URLS = [
    "https://github.com/security",
    "https://www.python.org",
    "https://openai.com",
    "https://www.nytimes.com",
    "https://www.mozilla.org",
]
