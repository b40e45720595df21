"""Feature transformers (no fit) and feature estimators (fit first)."""

from pyspark.ml import feature as ml

from . import counting
from .base import constructor

# transformers
binarizer = constructor(ml.Binarizer)
bucketizer = constructor(ml.Bucketizer)
dct = constructor(ml.DCT)
elementwise_product = constructor(ml.ElementwiseProduct)
feature_hasher = constructor(ml.FeatureHasher)
hashing_tf = constructor(ml.HashingTF)
index_to_string = constructor(ml.IndexToString)
interaction = constructor(ml.Interaction)
ngram = constructor(ml.NGram)
normalizer = constructor(ml.Normalizer)
polynomial_expansion = constructor(ml.PolynomialExpansion)
regex_tokenizer = constructor(ml.RegexTokenizer)
sql_transformer = constructor(ml.SQLTransformer)
stop_words_remover = constructor(ml.StopWordsRemover)
tokenizer = constructor(ml.Tokenizer)
vector_assembler = constructor(ml.VectorAssembler)
vector_size_hint = constructor(ml.VectorSizeHint)
vector_slicer = constructor(ml.VectorSlicer)

# estimators
bucketed_random_projection_lsh = constructor(ml.BucketedRandomProjectionLSH)
chi_sq_selector = constructor(ml.ChiSqSelector)
count_vectorizer = constructor(counting.CountVectorizer)
idf = constructor(ml.IDF)
imputer = constructor(ml.Imputer)
max_abs_scaler = constructor(ml.MaxAbsScaler)
min_hash_lsh = constructor(ml.MinHashLSH)
min_max_scaler = constructor(ml.MinMaxScaler)
one_hot_encoder = constructor(ml.OneHotEncoder)
pca = constructor(ml.PCA)
quantile_discretizer = constructor(ml.QuantileDiscretizer)
r_formula = constructor(ml.RFormula)
robust_scaler = constructor(ml.RobustScaler)
standard_scaler = constructor(ml.StandardScaler)
string_indexer = constructor(ml.StringIndexer)
target_encoder = constructor(ml.TargetEncoder)
univariate_feature_selector = constructor(ml.UnivariateFeatureSelector)
variance_threshold_selector = constructor(ml.VarianceThresholdSelector)
vector_indexer = constructor(ml.VectorIndexer)
word2vec = constructor(ml.Word2Vec)


# dictionary-driven models: apply a governed dictionary without a fit
def string_indexer_from_labels(labels, input_col, output_col=None, handle_invalid=None):
    return ml.StringIndexerModel.from_labels(labels, input_col, output_col, handle_invalid)


def string_indexer_from_arrays_of_labels(
    arrays, input_cols, output_cols=None, handle_invalid=None
):
    return ml.StringIndexerModel.from_arrays_of_labels(
        arrays, input_cols, output_cols, handle_invalid
    )


def count_vectorizer_from_vocabulary(vocabulary, input_col, output_col=None, **rules):
    """``rules``: ``min_tf`` and ``binary`` of the model."""
    return ml.CountVectorizerModel.from_vocabulary(
        vocabulary, input_col, output_col, rules.get("min_tf"), rules.get("binary")
    )


def default_stop_words(language: str = "english") -> list[str]:
    return ml.StopWordsRemover.loadDefaultStopWords(language)
