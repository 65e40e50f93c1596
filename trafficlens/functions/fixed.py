"""Fixed values that must equal the reference pipeline's for equal results.

Everything in this module is data, not logic: class names, status codes,
token lists and regex lists, written out plainly and in their natural order.
The regexes are Python-``re`` syntax; ``trafficlens.functions.regex`` turns a
list into one Java alternation for ``rlike`` (and into RE2 for the DuckDB
oracle queries).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference; do not edit for style)
# ---------------------------------------------------------------------------

# Classes of the classifier, plus the two sentinels.
CLASSES = ["legitimate_human", "legitimate_bot", "illegitimate_human", "illegitimate_bot"]
UNKNOWN_CLASS = "unknown"
ERROR_CLASS = "error"
ILLEGITIMATE_CLASSES = ["illegitimate_human", "illegitimate_bot"]

# Redirect status codes dropped when parsing log files.
REDIRECT_STATUS_CODES = [301, 302, 303, 304, 305, 307, 308]

# Combined log format line; start-anchored, end unanchored.
ACCESS_LOG_REGEX = r'^(\d+\.\d+\.\d+\.\d+) - - \[([^\]]+)\] "([^"]*)" (\d+) ([^ ]+) "([^"]*)" "([^"]*)"'
ACCESS_LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Blocklist line: "ip # CC ASN organisation".  The training profile anchors
# the end, the serving profile does not; both capture the same groups.
BLOCKLIST_LINE_REGEX = r"^(\d+\.\d+\.\d+\.\d+)\s+#\s+(\w+)\s+(\w+\d+)\s+(.+)$"

# Malicious user-agent fallback list (used when no list file is given).
FALLBACK_MALICIOUS_USER_AGENTS = [
    "python-requests", "Go-http-client", "curl", "wget",
    "Raccoon", "Stealer", "Bot", "RAT", "Malware",
    "axios", "aiohttp", "stratus-red-team",
]

# ---- training profile (T) --------------------------------------------------
T_SUSPICIOUS_PATH_REGEX = "wp-login|xmlrpc|admin|config|passwd|etc"
T_KNOWN_BOT_REGEX = "bot|crawl|spider|slurp|bingpreview"
T_COMMON_BROWSER_REGEX = "Chrome|Firefox|Safari|Edge|MSIE|Opera"
T_OLD_BROWSER_REGEX = (
    "MSIE [1-9]|MSIE 10|Firefox/[1-2][0-9]|Chrome/[1-3][0-9]|Safari/[1-5]|"
    "Android [1-4]|Opera/[1-9]|Opera/1[0-2]"
)
T_HIGH_RISK_COUNTRIES = ["CN", "RU", "BR", "KR", "IR", "KP"]
T_FLAGGED_ASN = "AS9009"

# ---- serving profile (S) ---------------------------------------------------
S_HIGH_RISK_COUNTRIES = ["CN", "RU", "IR", "KP", "SY", "VN"]

S_SUSPICIOUS_PATH_PATTERNS = [
    r'/(wp-admin|administrator|admin|phpmyadmin|myadmin|mysql|wp-login|xmlrpc)',
    r'\.(git|svn|htaccess|env|config)',
    r'/(shell|backdoor|hack|exploit|cmd|command|exec|eval|system)',
    r'/(passwd|shadow|etc/passwd|etc/shadow)',
    r'/(config|configuration|setup|install|backup|dump)',
    r'/(sql|database|db|mysql|mysqli|oracle|postgresql)',
    r'/(php|asp|aspx|jsp|cgi|pl|py|rb|sh|bash)',
    r'/(login|logon|signin|signup|register|auth|authenticate)',
    r'/(upload|file|download|attachment)',
    r'/(test|demo|sample|example|temp|tmp)',
]

# Case-sensitive.
S_OLD_BROWSER_PATTERNS = [r'MSIE [1-9]\.', r'Firefox/[1-9]\.', r'Chrome/[1-9]\.', r'Safari/[0-9]']

S_KNOWN_BOT_PATTERNS = [
    r'bot', r'crawler', r'spider', r'slurp', r'googlebot', r'bingbot', r'yandex',
    r'baidu', r'duckduck', r'yahoo', r'archive', r'facebook', r'twitter',
    r'semrush', r'ahrefs', r'moz', r'majestic', r'screaming',
]

S_SUSPICIOUS_UA_PATTERNS = [
    r'(acunetix|appscan|burp|dirbuster|nessus|netsparker|nikto|nmap|paros|qualys|scanner|sqlmap|webinspect|whatweb|zmeu)',
    r'(curl|wget|python-requests|go-http-client|ruby|perl|bash|powershell)',
    r'(masscan|zgrab|gobuster|wfuzz|ffuf|feroxbuster)',
    r'(nuclei|subfinder|amass|httpx|gau|waybackurls)',
    r'(xss|sqli|rce|lfi|rfi|ssrf|csrf|xxe|ssti|deserialization)',
]

S_SQL_PATTERNS = [
    r'(\%27)|(\')|(\-\-)|(\%23)|(#)',
    r'((\%3D)|(=))[^\n]*((\%27)|(\')|(\-\-)|(\%3B)|(;))',
    r'((\%27)|(\'))((\%6F)|o|(\%4F))((\%72)|r|(\%52))',
    r'((\%27)|(\'))union',
    r'exec(\s|\+)+(s|x)p\w+',
    r'UNION\s+ALL\s+SELECT',
    r'SELECT\s+FROM',
    r'INSERT\s+INTO',
    r'UPDATE\s+SET',
    r'DELETE\s+FROM',
]

S_XSS_PATTERNS = [
    r'<script>',
    r'<img[^>]+src[^>]+onerror',
    r'javascript:',
    r'onload=',
    r'onclick=',
    r'onmouseover=',
    r'eval\(',
    r'document\.cookie',
    r'document\.location',
    r'document\.write',
    r'alert\(',
    r'prompt\(',
    r'confirm\(',
]

S_CMD_PATTERNS = [
    r';.*(bash|sh|ksh|csh|cat|pwd|ls|cp|mv|rm|ps|wget|curl|lynx|python|perl|ruby)',
    r'\|(bash|sh|ksh|csh|cat|pwd|ls|cp|mv|rm|ps|wget|curl|lynx|python|perl|ruby)',
    r'`(bash|sh|ksh|csh|cat|pwd|ls|cp|mv|rm|ps|wget|curl|lynx|python|perl|ruby)`',
    r'\$\((bash|sh|ksh|csh|cat|pwd|ls|cp|mv|rm|ps|wget|curl|lynx|python|perl|ruby)\)',
    r'system\(',
    r'exec\(',
    r'shell_exec\(',
    r'passthru\(',
    r'popen\(',
]

S_FILE_PATTERNS = [
    r'(\.\.\/)+',
    r'\/etc\/passwd',
    r'\/etc\/shadow',
    r'\/etc\/hosts',
    r'\/proc\/self\/environ',
    r'\/var\/log',
    r'\/var\/www',
    r'\/bin\/sh',
    r'c:\\windows',
    r'cmd\.exe',
    r'php:\/\/input',
    r'data:\/\/',
    r'expect:\/\/',
    r'file:\/\/',
]

S_WORDPRESS_PATTERNS = [
    r'\/wp-admin',
    r'\/wp-content',
    r'\/wp-includes',
    r'\/wp-json',
    r'\/xmlrpc\.php',
    r'\/wp-login\.php',
    r'\/wp-config\.php',
    r'\/wp-cron\.php',
    r'\/wp-load\.php',
    r'\/wp-mail\.php',
    r'\/wp-settings\.php',
    r'\/wp-signup\.php',
    r'\/wp-activate\.php',
    r'\/wp-trackback\.php',
]

S_SHELL_PATTERNS = [
    r'(c99|r57|shell|b374k|weevely)\.php',
    r'(shell|cmd|command|exec|system|passthru)\.php',
    r'(backdoor|rootkit|webshell)\.php',
    r'(upload|uploader|upload_file|upload-file)\.php',
    r'(adminer|phpmy|myadmin|mysql)\.php',
]

S_MALICIOUS_EXT_PATTERNS = [
    r'\.php[3-7]',
    r'\.phtml',
    r'\.pht',
    r'\.phps',
    r'\.phar',
    r'\.php_',
    r'\.php-',
    r'\.php\.',
    r'\.php~',
    r'\.php#',
    r'\.php:',
]

# Path-traversal test used by the attack report.
PATH_TRAVERSAL_REGEX = r'\.\.|%2e%2e|/etc/|/var/|/bin/'

# Section names of the threat-pattern file, in file order of the category list.
THREAT_CATEGORIES = [
    "query_string", "request_uri", "user_agent", "referrer", "common_attack",
    "file_inclusion", "command_injection", "xss", "wordpress", "sql_injection",
    "shell_upload", "malicious_file_ext", "additional_malicious", "obfuscation",
    "crypto_mining", "ransomware", "attack_tools", "additional_tools",
]

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# Corrected "old browser" presets (Q9; own design, not reference values).  The
# reference patterns above match version prefixes ("Firefox/[1-2][0-9]" also
# hits Firefox/121, "Chrome/[1-3][0-9]" hits Chrome/120) and read Safari's
# version from the "Safari/<WebKit build>" token, which every Safari UA has.
# Here a major version must end at its dot, and Safari's version is the
# "Version/<n>" token.  Upper version bounds as in the reference presets;
# single-digit majors (older still) are included.
T_OLD_BROWSER_REGEX_CORRECTED = (
    r"MSIE [1-9]\.|MSIE 10\.|Firefox/[1-2]?[0-9]\.|Chrome/[1-3]?[0-9]\.|"
    r"Version/[1-5]\.[0-9.]* (Mobile/\S+ )?Safari/|Android [1-4]\.|Opera/[1-9]\.|Opera/1[0-2]\."
)
S_OLD_BROWSER_PATTERNS_CORRECTED = [r"MSIE [1-9]\.", r"Firefox/[1-9]\.", r"Chrome/[1-9]\.",
                                    r"Version/[1-9]\.[0-9.]* (Mobile/\S+ )?Safari/"]

OLD_BROWSER_PRESETS = {
    "train": {"reference": [T_OLD_BROWSER_REGEX], "corrected": [T_OLD_BROWSER_REGEX_CORRECTED]},
    "serve": {"reference": S_OLD_BROWSER_PATTERNS, "corrected": S_OLD_BROWSER_PATTERNS_CORRECTED},
}

# Serving-profile family lists keyed by the output flag they set.
S_FAMILIES = {
    "sql_injection_matches": S_SQL_PATTERNS,
    "xss_matches": S_XSS_PATTERNS,
    "cmd_injection_matches": S_CMD_PATTERNS,
    "file_inclusion_matches": S_FILE_PATTERNS,
    "wordpress_matches": S_WORDPRESS_PATTERNS,
    "shell_upload_matches": S_SHELL_PATTERNS,
    "malicious_ext_matches": S_MALICIOUS_EXT_PATTERNS,
}

# A labeller's answer: a fenced JSON block, else the outermost braces, else three quoted fields.
LABEL_FENCE_REGEX = r"(?s)```json\s*(\{.*?\})\s*```"
LABEL_BRACES_REGEX = r"(?s)(\{.*\})"
LABEL_CLASSIFICATION_REGEX = r'"classification":\s*"([^"]+)"'
LABEL_CONFIDENCE_REGEX = r'"confidence":\s*([\d.]+)'
LABEL_REASONING_REGEX = r'"reasoning":\s*"([^"]+)"'

# A generated answer, and the texts that stand for what it lacks.
ANSWER_CLASSIFICATION_REGEX = r"Classification:\s*(\w+)"
ANSWER_CONFIDENCE_REGEX = r"Confidence:\s*([\d.]+)"
ANSWER_REASONING_REGEX = r"(?s)Reasoning:\s*(.+?)(?=$|\n\n)"
NO_REASONING = "No reasoning provided"
ANSWER_ERROR = "Error parsing model output"

# Shares of the approximate user-agent series: old browsers of illegitimate humans, no user agent of illegitimate bots.
OLD_BROWSER_SHARE = 0.7
NO_USER_AGENT_SHARE = 0.3

# Weights of the address and of its network in the combined reputation score.
IP_REPUTATION_WEIGHT = 0.7
ASN_REPUTATION_WEIGHT = 0.3
