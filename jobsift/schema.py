"""Table schemas, vocabularies and sentinel values.

The ``Vocabulary`` dataclass carries every list the operators whitelist
against, so the same operator runs on the original domain (Taiwanese job
boards, ``DOMAIN``) or on the bound test data (``jobsift.bindings``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- table schemas ---------------------------------------------------------

JOB = T.StructType([
    T.StructField("job_code", T.StringType(), False),
    T.StructField("job_title", T.StringType(), False),
    T.StructField("company_name", T.StringType(), False),
    T.StructField("job_location", T.StringType(), False),
    T.StructField("salary_period", T.StringType(), True),
    T.StructField("min_salary", T.LongType(), True),
    T.StructField("max_salary", T.LongType(), True),
    T.StructField("edu_level", T.StringType(), True),
    T.StructField("work_experience", T.StringType(), True),
    T.StructField("skills", T.StringType(), True),
    T.StructField("travel", T.StringType(), True),
    T.StructField("management", T.StringType(), True),
    T.StructField("remote", T.StringType(), True),
    T.StructField("job_source", T.StringType(), False),
    T.StructField("create_date", T.TimestampNTZType(), False),
])
JOB_COLUMNS = [f.name for f in JOB.fields]

JOB_CATEGORY = T.StructType([
    T.StructField("job_code", T.StringType(), False),
    T.StructField("job_category", T.StringType(), False),
])

USER = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("password", T.StringType(), True),
])

USER_BOOKMARK = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("job_code", T.StringType(), False),
])

# Canonical landed record: 14 scalars then the category list, in slot order.
RECORD_FIELDS = [
    "job_title", "job_code", "company_name", "job_location", "salary_period",
    "min_salary", "max_salary", "edu_level", "work_experience", "skills",
    "travel", "management", "remote", "job_source", "job_category",
]
RECORD = T.StructType(
    [T.StructField(n, T.LongType() if n in ("min_salary", "max_salary") else T.StringType())
     for n in RECORD_FIELDS[:-1]]
    + [T.StructField("job_category", T.ArrayType(T.StringType()))]
)

# --- fixed values: field names of the boards' JSON, as they are sent -------
# Job-detail JSON of the JSON board (only the fields the record needs).
_DESC = T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))
JSON_DETAIL = T.StructType([T.StructField("data", T.StructType([
    T.StructField("switch", T.StringType()),
    T.StructField("header", T.StructType([
        T.StructField("jobName", T.StringType()),
        T.StructField("custName", T.StringType()),
    ])),
    T.StructField("jobDetail", T.StructType([
        T.StructField("addressRegion", T.StringType()),
        T.StructField("salary", T.StringType()),
        T.StructField("salaryMin", T.LongType()),
        T.StructField("salaryMax", T.LongType()),
        T.StructField("businessTrip", T.StringType()),
        T.StructField("manageResp", T.StringType()),
        T.StructField("remoteWork", T.StringType()),
        T.StructField("jobCategory", _DESC),
    ])),
    T.StructField("condition", T.StructType([
        T.StructField("edu", T.StringType()),
        T.StructField("workExp", T.StringType()),
        T.StructField("specialty", _DESC),
    ])),
]))])

# Paged listing JSON: data.list[].link.job
JSON_LISTING = T.StructType([T.StructField("data", T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("link", T.StructType([T.StructField("job", T.StringType())])),
    ]))),
]))])

# --- fixed values that must equal the original application's ---------------
# These are data, stated as they appear in the original domain.

# Sentinels: unknown salary is 0/0, open-ended maximum, negotiable marker.
UNKNOWN_SALARY = 0
OPEN_MAX_SALARY = 9999999
NEGOTIABLE = "待遇面議"
YEARLY = "年薪"
HOURLY = "時薪"
MONTHLY = "月薪"

# Ten tracked categories and their history-table column names.
TRACKED_CATEGORIES = {
    "iOS工程師": "ios",
    "Android工程師": "android",
    "前端工程師": "frontend",
    "後端工程師": "backend",
    "全端工程師": "fullstack",
    "數據分析師": "data_analyst",
    "資料科學家": "data_scientist",
    "資料工程師": "data_engineer",
    "AI工程師": "ai_engineer",
    "資料庫管理人員": "db_admin",
}

# Region whitelist (first three characters of the address).
REGIONS = [
    "連江縣", "台北市", "新北市", "桃園市", "台中市",
    "台南市", "高雄市", "宜蘭縣", "新竹縣", "苗栗縣",
    "彰化縣", "南投縣", "雲林縣", "嘉義縣", "屏東縣",
    "花蓮縣", "台東縣", "澎湖縣", "基隆市", "新竹市",
    "嘉義市",
]

# Education whitelist (first two characters of the education text).
EDU_PREFIXES = ["不拘", "高中", "專科", "大學", "碩士", "博士"]

# Closed vocabularies of an extracted posting.
EDU_LEVELS = ["不拘", "高中職", "專科", "大學", "碩士", "博士"]
EXPERIENCE_PATTERN = r"^(不拘|[0-9]+年以上)$"
TRAVEL_VALUES = ["需出差外派", "無需出差外派"]
MANAGEMENT_VALUES = ["需負擔管理責任", "不需負擔管理責任"]
REMOTE_VALUES = ["可遠端工作", "不可遠端工作"]
REMOTE_YES = "可遠端工作"
REMOTE_NO = "不可遠端工作"

# Category vocabulary an extracted posting must pick 1 to 3 entries from.
CATEGORY_VOCABULARY = [
    "iOS工程師", "Android工程師", "前端工程師", "後端工程師",
    "全端工程師", "數據分析師", "軟體工程師", "軟體助理工程師", "軟體專案主管", "系統分析師",
    "資料科學家", "資料工程師", "AI工程師", "演算法工程師", "韌體工程師", "電玩程式設計師",
    "Internet程式設計師", "資訊助理", "區塊鏈工程師", "BIOS工程師", "通訊軟體工程師",
    "電子商務技術主管", "其他資訊專業人員", "MIS／網管類人員", "系統工程師", "網路管理工程師",
    "資安工程師", "資訊設備管制人員", "雲端工程師", "網路安全分析師", "MES工程師", "MIS程式設計師",
    "資料庫管理人員", "MIS／網管主管", "資安主管", "軟體／工程類人員",
]

# Label texts of the HTML detail page and the record field each one fills.
DETAIL_LABELS = {
    "薪資待遇": "salary_period",
    "上班地點": "job_location",
    "職務類別": "job_category",
    "工作經驗": "work_experience",
    "管理責任": "management",
    "是否出差": "travel",
    "教育程度": "edu_level",
    "電腦專長": "skills",
}
CATEGORY_SEPARATOR = "、"

# Job-code patterns in listing links, one per board.
CODE_PATTERNS = {
    "json_board": r"/job/([a-zA-Z0-9]+)\?",
    "html_board": r"job-(\w+)\.html",
    "hk_board": r"/job/(\d+)\?",
    "jp_board": r"\d{10}",
}
# Monthly salary range text, thousands separated.
MONTHLY_RANGE_PATTERN = r"月薪 (\d{1,3}(?:,\d{3})*) 至 (\d{1,3}(?:,\d{3})*)"

# Sign-up rules.
EMAIL_PATTERN = r"^[_a-z0-9-]+(\.[_a-z0-9-]+)*@[a-z0-9-]+(\.[a-z0-9-]+)*(\.[a-z]{2,4})$"
PASSWORD_PATTERN = r"^[A-Za-z0-9@#$%^&+=]{8,}"

# Class names of the HTML board's pages.
ARTICLE_CLASS, ARTICLE_TITLE_CLASS = "all_job_hover", "job__title__inner"
DETAIL_BOX_CLASS, DETAIL_PART_CLASS, DETAIL_LABEL_CLASS = "job-detail-box", "wrapper", "jobItemName"
JOB_TITLE_CLASS, COMPANY_CLASS = "job-title", "company-info-container"

# Page sizes.
SEARCH_PAGE_SIZE = 10
RECOMMEND_SIZE = 5
SIMILAR_SIZE = 2
PROFILE_SIZE = 5
SERIES_DAYS = 7
TOP_TERMS = 400
LISTING_PAGE_SIZE = 30

# Load dates are calendar dates at UTC+8.
LOAD_DATE_OFFSET_HOURS = 8
MAX_TEXT_LENGTH = 255


@dataclass(frozen=True)
class Vocabulary:
    """Whitelists and names one deployment filters and reports on."""

    tracked: dict = field(default_factory=lambda: dict(TRACKED_CATEGORIES))
    regions: list = field(default_factory=lambda: list(REGIONS))
    region_chars: int = 3
    edu_prefixes: list = field(default_factory=lambda: list(EDU_PREFIXES))
    edu_chars: int = 2
    category_vocabulary: list = field(default_factory=lambda: list(CATEGORY_VOCABULARY))


DOMAIN = Vocabulary()
