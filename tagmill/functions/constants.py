"""Fixed values."""

# District names and the codes they translate to.
DISTRICT_CODES = {
    "平谷区": "PingGu",
    "密云县": "MiYun",
    "大兴区": "DaXing",
    "海淀区": "HaiDian",
    "房山区": "FangShan",
    "东城区": "DongCheng",
    "丰台区": "FengTai",
    "昌平区": "ChangPing",
    "怀柔区": "HuaiRou",
    "石景山区": "ShiJingShan",
    "门头沟区": "MenTouGou",
    "延庆县": "YanQing",
    "通州区": "TongZhou",
    "顺义区": "ShunYi",
    "西城区": "XiCheng",
    "朝阳区": "ChaoYang",
}
UNKNOWN_DISTRICT_CODE = "Bug"

# Label texts that mean "not filled in".
EMPTY_AGE = "年龄为空"
EMPTY_SEX = "性别为空"

# Carrier codes of the carrier cohort.
CARRIER_CODES = ("46001", "46006")

# Fixed value: apps whose name contains this text are ignored.
EXCLUDED_APP = "systemui"

# Defaults of missing text columns and of failed lookups.
MISSING_ENTITY = "TDID missing"
MISSING_DISTRICT = "District missing"
MISSING_AGE = "Age missing"
UNKNOWN = "Unknown"
UNKNOWN_CATEGORY = "UnknownCategory"
NOT_FOUND = "Not Found"
NOT_AVAILABLE = "N/A"

# Thresholds of tagging and pseudo-labelling.
TAG_HIGH = 0.65
TAG_LOW = 0.40
SAMPLE_HIGH = 0.95
SAMPLE_LOW = 0.15

# Ids of the positive and the negative tag in audience files.
TAG_IDS = {"pos": "304", "neg": "305"}

# Seed of training and splitting, records kept per entity,
# class count assumed for a class that never occurs, smoothing terms.
SEED = 12345
RECORDS_PER_ENTITY = 20
MISSING_CLASS_COUNT = 3
ENTROPY_EPSILON = 1e-7
PROBABILITY_FLOOR = 1e-8

# Radius and neighbour count of density clustering.
CLUSTER_RADIUS = 1.39
CLUSTER_MIN_POINTS = 5
