"""Fixed values that must equal the reference's for the same results.

They are parameters of the reference's exercises, stated here once, in the
order the exercises use them, and referenced by the checked queries (and
mirrored literally in their SQL twins).
"""

# Fixed values.
SAMPLE_FRACTION = 0.5          # sample(False, 0.5, seed)
SEED = 42                      # sampling and model seed
SIGMA_WIDTH = 3.0              # mean +- 3 standard deviations
MAX_MISSING_SHARE = 0.6        # drop columns more than 60% missing
ACRES_TO_SQFT = 43560.0        # square feet per acre
WEEKEND_THRESHOLD = 5.0        # Binarizer threshold on Monday=1..Sunday=7
BUCKET_SPLITS = [0, 1, 2, 3, 4, 5, float("inf")]  # Bucketizer splits
TEST_DAYS = 45                 # last 45 days are the test set
MIN_OBSERVATIONS = 30          # drop binary columns with at most 30 ones
