"""Fixed values of the crawl model. All of them are defaults; functions take them as parameters."""

# Page type codes.
PAGE_TYPES = ["HTML", "BINARY", "DUPLICATE", "FRONTIER", "FAILED", "CRAWLING", "REDIRECT"]

# Document type codes.
DATA_TYPES = ["PDF", "DOC", "DOCX", "PPT", "PPTX", "ZIP", "RAR", "XLSX", "XLSM", "UNKNOWN"]

# Start URLs.
SEED_URLS = [
    "https://gov.si/",
    "https://evem.gov.si/",
    "https://e-uprava.gov.si/",
    "https://e-prostor.gov.si/",
]

# File name extensions of images and of binary documents.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".jfif", ".pjpeg", ".pjp", ".png", ".apng", ".avif", ".gif", ".webp", ".svg",
                    ".eps", ".pdf", ".ico", ".cur", ".tif", ".tiff", ".bmp"]
BINARY_EXTENSIONS = [".pdf", ".doc", ".docx", ".ppt", ".pptx", ".zip", ".rar", ".xlsx", ".xlsm"]

# Patterns (Java regular expressions).
ALLOWED_NETLOC = r"^[^\n]*\.gov\.si$"
FULL_URL = r"^https?://[A-Za-z0-9]+(?:\.[A-Za-z]+){2,}+[^\n]*$"
RELATIVE_URL = r"^(?:/[^\n]*)?$"
ONCLICK_ASSIGN = r"""^[^\n]*location(?:[^\n]href)? = ["']([^\n]*)["']"""
ONCLICK_CALL = r"""^[^\n]*location(?:[^\n]href)?[^\n][^\n]*\(["']([^\n]*)["']\)"""

# Politeness and statuses.
DEFAULT_DELAY_SECONDS = 5
REDIRECT_STATUS = 301
QUIET_ERRORS = ["net::ERR_BAD_SSL_CLIENT_AUTH_CERT", "net::ERR_CONNECTION_RESET", "net::ERR_ABORTED",
                "net::ERR_EMPTY_RESPONSE"]
DOWNLOAD_ERROR = "net::ERR_ABORTED"

# The robots.txt name this crawler answers to; pass your own to the robots functions.
DEFAULT_AGENT = "crawlspark"
