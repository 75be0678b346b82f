"""Vocabularies, labels and formats that decide the results.

Everything here is data.  How it is applied (priority, matching rule) lives in
the expression builders next to this module.
"""

# --- Fixed values: salary -------------------------------------------------
NEGOTIABLE_PHRASES = ("thoả thuận", "thỏa thuận", "thương lượng", "negotiable", "cạnh tranh")
USD_MARKS = ("usd", "$")
FROM_PREFIXES = ("từ", "trên", "above", "from")
TO_PREFIXES = ("tới", "dưới", "up to", "to")
FIRST_AMOUNT = r"(\d+[\.,]?\d*)"
SECOND_AMOUNT = r"[-–~][\s]*(\d+[\.,]?\d*)"
USD_CURRENCY = "USD"
VND_CURRENCY = "tr VND"
USD_TO_MILLION_VND = 0.025
PLAIN_VND_ABOVE = 1000
VND_PER_MILLION = 1_000_000
BAND_NEGOTIABLE = "Negotiable"
BAND_BELOW_10 = "< 10tr"
BAND_10_TO_20 = "10tr - 20tr"
BAND_20_TO_30 = "20tr - 30tr"
BAND_ABOVE_30 = "> 30tr"

# --- Fixed values: place name -> spellings --------------------------------
PLACES = {
    "Hồ Chí Minh": (
        "hồ chí minh", "hcm", "tp.hcm", "tp hcm", "ho chi minh",
        "thành phố hồ chí minh", "saigon", "sài gòn",
    ),
    "Hà Nội": ("hà nội", "ha noi", "hanoi", "hn"),
    "Đà Nẵng": ("đà nẵng", "da nang"),
    "Hải Phòng": ("hải phòng", "hai phong"),
    "Cần Thơ": ("cần thơ", "can tho"),
    "Bình Dương": ("bình dương", "binh duong"),
    "Đồng Nai": ("đồng nai", "dong nai"),
    "Oversea": ("oversea", "overseas", "nước ngoài"),
}

# --- Fixed values: level name -> spellings, lowest rank first --------------
LEVELS = {
    "Intern": ("thực tập", "intern"),
    "Fresher": ("fresher", "mới tốt nghiệp"),
    "Junior": ("junior", "nhân viên"),
    "Middle": ("middle",),
    "Senior": ("senior",),
    "Lead": ("trưởng nhóm", "team lead", "lead"),
    "Manager": ("trưởng phòng", "manager", "quản lý"),
    "Director": ("giám đốc", "director"),
}

# --- Fixed values: experience ----------------------------------------------
EXPERIENCE_NOT_REQUIRED = ("không yêu cầu", "not required", "không cần")
EXPERIENCE_UNDER = ("dưới", "under", "less")
EXPERIENCE_OVER = ("trên", "above", "over")
NOT_REQUIRED_LABEL = "Not required"

# --- Fixed values: working type -> spellings, strongest first ---------------
WORKING_TYPES = {
    "Hybrid": ("hybrid", "kết hợp"),
    "Remote": ("remote", "từ xa"),
    "Onsite": ("onsite", "office", "văn phòng"),
}

# --- Fixed values: skills looked for in titles -> display name -------------
TITLE_SKILLS = {
    "python": "Python", "java": "Java", "javascript": "Javascript", "react": "React",
    "angular": "Angular", "vue": "Vue", "nodejs": "NodeJS", "c++": "C++", "c#": "C#",
    "ruby": "Ruby", "php": "Php", "golang": "Golang", "go": "Go", "swift": "Swift",
    "kotlin": "Kotlin", "aws": "AWS", "azure": "Azure", "gcp": "GCP", "docker": "Docker",
    "kubernetes": "Kubernetes", "sql": "SQL", "nosql": "Nosql", "mysql": "Mysql",
    "postgresql": "Postgresql", "mongodb": "Mongodb", "oracle": "Oracle", "spark": "Spark",
    "hadoop": "Hadoop", "kafka": "Kafka", "django": "Django", "spring": "Spring",
    "laravel": "Laravel", "flutter": "Flutter", "react native": "React Native",
    "unity": "Unity", "tensorflow": "Tensorflow", "pytorch": "Pytorch", "html": "Html",
    "css": "Css", "linux": "Linux", "bash": "Bash", "shell": "Shell", "git": "Git",
    "ci/cd": "CI/CD", "elasticsearch": "Elasticsearch", "redis": "Redis",
}

# --- Fixed values: job category -> title keywords ---------------------------
JOB_CATEGORIES = {
    "Data Engineer": ("data engineer", "data warehouse", "etl", "big data", "kỹ sư dữ liệu"),
    "Data Analyst": (
        "data analyst", "phân tích dữ liệu", "business intelligence", "bi analyst",
        "data analysis", "analytics",
    ),
    "Data Scientist": ("data scientist", "khoa học dữ liệu", "machine learning", "deep learning"),
    "Fullstack Developer": ("fullstack", "full-stack", "full stack"),
    "Backend Developer": (
        "backend", "back-end", "back end", "python", "java", "php", "nodejs", "c#", "c++",
        ".net", "golang", "ruby", "software",
    ),
    "Frontend Developer": (
        "frontend", "front-end", "front end", "react", "angular", "vue", "html", "css",
        "web developer",
    ),
    "Mobile Developer": (
        "mobile", "ios", "android", "flutter", "react native", "swift", "kotlin",
    ),
    "DevOps / SRE": (
        "devops", "sre", "system admin", "sysadmin", "infrastructure", "quản trị hệ thống",
        "cloud",
    ),
    "QA/QC / Tester": ("qa", "qc", "tester", "kiểm thử", "automation test"),
    "Project Manager": (
        "project manager", "quản lý dự án", "scrum master", "product manager", "po",
    ),
    "Business Analyst": ("business analyst", "ba", "phân tích nghiệp vụ"),
    "Security / IT Support": (
        "security", "bảo mật", "it support", "helpdesk", "kỹ thuật viên it",
    ),
    "AI Engineer": ("ai", "ai engineer", "trí tuệ nhân tạo"),
}
OTHER_CATEGORY = "Others"

# --- Fixed values: keys and rejects -----------------------------------------
JOB_ID_SEPARATOR = "||"
REJECT_REASON = "Missing mandatory fields"

# --- Fixed values: texts shown for a search hit ------------------------------
NO_TITLE = "Không rõ"
NO_COMPANY = "Không rõ công ty"
NO_SALARY = "Thỏa thuận"
SALARY_FROM = "Từ "
SALARY_UP_TO = "Lên đến "
NO_PLACE = "Nhiều nơi"
NO_URL = "#"
NO_LEVEL = "Không yêu cầu"
NO_DATE = "Chưa rõ"
