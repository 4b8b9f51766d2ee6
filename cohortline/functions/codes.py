"""Tokens, code dictionaries and column lists of the two record tables.

These must equal the values of the data they describe; nothing here is logic.
"""

# Text that stands for a missing value in a delimited file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# First record table.
FIRST_RENAMES = {"patientid": "patient_id"}
FIRST_STAGE_CODES = {"I": "1", "II": "2", "IIIa": "3", "IIIb": "3"}
FIRST_ORDINALS = ["clinical_t_stage", "clinical_n_stage", "clinical_m_stage", "overall_stage"]
FIRST_DROPPED = ["survival_time", "deadstatus_event"]

# Second record table.
SECOND_RENAMES = {
    "case_id": "patient_id",
    "patient_affiliation": "affiliation",
    "age_at_histological_diagnosis": "age",
    "weight_lbs": "weight",
    "gg": "gg_percentage",
    "pathological_t_stage": "clinical_t_stage",
    "pathological_n_stage": "clinical_n_stage",
    "pathological_m_stage": "clinical_m_stage",
    "histopathological_grade": "overall_stage",
    "pleural_invasion_elastic_visceral_or_parietal": "pleural_invasion",
}
SECOND_DROPPED_FIRST = [
    "recurrence", "recurrence_location", "alk_translocation_status",
    "tumor_location_l_lingula", "tumor_location_unknown", "date_of_recurrence",
    "quit_smoking_year",
]
SECOND_CODES = {
    # missing
    "not assessed": None, "not recorded in database": None,
    "not collected": None, "unknown": None,
    # outcome
    "dead": "1", "alive": "0",
    # percentage bands
    "0%": "0", ">0 - 25%": "1", "25 - 50%": "2", "50 - 75%": "3",
    "75 - < 100%": "4", "100%": "5",
    # T, N and M stages
    "tis": "0", "t1a": "1", "t1b": "1", "t2a": "2", "t2b": "2", "t3": "3", "t4": "4",
    "n0": "0", "n1": "1", "n2": "2", "n3": "3",
    "m0": "0", "m1a": "1", "m1b": "2", "m1c": "3",
    # grade
    "g1 well differentiated": "1",
    "other, type i: well to moderately differentiated": "1",
    "g2 moderately differentiated": "2",
    "other, type ii: moderately to poorly differentiated": "2",
    "g3 poorly differentiated": "3",
    # words
    "nsclc nos (not otherwise specified)": "nos",
    "asian": "other",
    "african-american": "other",
    "hispanic/latino": "other",
    "native hawaiian/pacific islander": "other",
}
SECOND_ORDINALS = [
    "gg_percentage", "clinical_t_stage", "clinical_n_stage", "clinical_m_stage",
    "overall_stage",
]
SECOND_DROPPED_LAST = [
    "date_of_last_known_alive", "survival_status", "date_of_death",
    "time_to_death_days", "ct_date", "days_between_ct_and_surgery", "pet_date",
]

# Column order of an image feature row.
IMAGE_FEATURES = [
    "n_tumours", "maximum_diameter", "surface_area", "surface_to_volume_ratio",
    "volume", "radius", "sphericity", "elongation", "compactness",
    "mean_intensity", "std_intensity", "min_intensity", "max_intensity",
    "median_intensity",
    "contrast", "correlation", "dissimilarity", "homogeneity", "energy",
]

# Study defaults.
DATASETS = ["clinical1", "clinical2", "clinical_joined", "image_features", "full_data"]
RANDOM_SEED = 42
TEST_SHARE = 0.2
K_FOLDS = 5
N_BATCHES = 12
LASSO_GRID = {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]}
MLP_GRID = {
    "hiddenLayers": [[100], [100, 100], [100, 50], [100, 25], [100, 50, 50], [100, 50, 25]],
    "alpha": [0.001, 0.01, 0.1],
    "batchSize": [32, 64],
    "maxIter": [1250, 1500, 1750, 2000, 2250, 2500],
}
