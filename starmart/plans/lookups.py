"""Fixed values of the hospital star: code lists and labels. Replace them to use the same models elsewhere."""

# Service line by diagnosis-group number, inclusive ranges; anything else is OTHER.
SERVICE_LINES = [
    (1, 14, "Transplants"),
    (20, 103, "Nervous system"),
    (163, 208, "Respiratory"),
    (215, 316, "Circulatory"),
    (326, 395, "Digestive"),
    (453, 566, "Musculoskeletal"),
    (573, 607, "Skin"),
    (614, 645, "Endocrine"),
    (652, 700, "Kidney/urinary"),
    (763, 795, "Pregnancy/newborn"),
    (808, 816, "Blood"),
    (853, 872, "Infectious/sepsis"),
]

# Diagnosis groups flagged as common.
COMMON_CODES = ["470", "871", "291", "312", "392", "775"]

# Condition by readmission measure.
CONDITIONS = {
    "READM-30-AMI-HRRP": "Heart attack",
    "READM-30-HF-HRRP": "Heart failure",
    "READM-30-PN-HRRP": "Pneumonia",
    "READM-30-COPD-HRRP": "COPD",
    "READM-30-HIP-KNEE-HRRP": "Hip/knee replacement",
    "READM-30-CABG-HRRP": "CABG (bypass)",
}

# Census region by state code; anything else (territories) is OTHER.
CENSUS_REGIONS = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": [
        "DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV",
        "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX",
    ],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}

# Urbanicity by the highest rural-urban commuting code of each class; above, unparsable and null are RURAL.
URBANICITY = [(3, "Metro"), (6, "Micro")]

OTHER = "Other"
RURAL = "Rural"
