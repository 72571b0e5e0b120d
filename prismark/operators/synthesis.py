"""Per-cluster synthesis prompts and model replies.

The model itself is a user scorer (see ``screen.score_with``).  Prompts are
built over the numbered corpus chunks of ``biblio.concat_cluster_text``
(a cluster can be too large for one row); replies are parsed with
``from_json`` against the reply layouts the prompts ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The two synthesis prompt layouts; {corpus_text} is replaced by the corpus.
THEMATIC_PROMPT = """You are an expert in scientific literature analysis.

**CORPUS TO ANALYZE:**
{corpus_text}

**INSTRUCTIONS:**
1. Carefully read the corpus above
2. Identify 3 to 5 main themes (no more than 5)
3. For each theme:
   - Provide a short title (3-6 words maximum)
   - Write a clear description (15-30 words)
   - List 3-5 relevant key concepts
4. Summarize the main message of the corpus in 1-2 sentences (20-40 words)
5. Each article is separated by \n\n--- NEW ARTICLE ---\n\n

**IMPORTANT RULES:**
- Base your analysis ONLY on the provided corpus
- Do not mention external information
- Use precise scientific vocabulary
- Remain factual and objective

**RESPONSE FORMAT:**
Respond in valid JSON only, with no text before or after. Exact structure:
{
  "thematic_axes": [
    {
      "article analysed:"Number of articles in the cluster"
      "theme": "theme title",
      "description": "short and precise description",
      "key_concepts": ["concept1", "concept2", "concept3"]
    }
  ],
  "main_message": "synthesis in a short paragraph"
}

JSON RESPONSE:"""

METHODOLOGY_PROMPT = """You are an expert in scientific research methodology.

**CORPUS TO ANALYZE:**
{corpus_text}

**INSTRUCTIONS:**
1. Carefully read the corpus above
2. Identify the dominant methodology (only one: meta-analysis, cohort study, randomized clinical trial, systematic review, modeling, cross-sectional study, etc.)
3. Describe common methodological characteristics in 20-40 words
4. List 3-7 statistical or algorithmic techniques identified in the corpus
5. List 2-5 tools, software, or databases mentioned (if present)
6. Each article is separated by \n\n--- NEW ARTICLE ---\n\n

**IMPORTANT RULES:**
- Extract ONLY information present in the corpus
- If information is not available, use an empty list []
- Use exact names of methods/tools as mentioned
- Avoid interpretations or assumptions
- Remain precise and factual

**RESPONSE FORMAT:**
Respond in valid JSON only, with no text before or after. Exact structure:
{
  "dominant_methodology": "precise methodology name",
  "methodological_description": "common characteristics in 20-40 words",
  "statistical_techniques": ["technique1", "technique2", "technique3"],
  "tools_databases": ["tool1", "tool2"]
}

JSON RESPONSE:"""

PROMPTS = {"themes": THEMATIC_PROMPT, "methodology": METHODOLOGY_PROMPT}

THEMES_SCHEMA = T.StructType([
    T.StructField("thematic_axes", T.ArrayType(T.StructType([
        T.StructField("theme", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("key_concepts", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("main_message", T.StringType()),
])

METHODOLOGY_SCHEMA = T.StructType([
    T.StructField("dominant_methodology", T.StringType()),
    T.StructField("methodological_description", T.StringType()),
    T.StructField("statistical_techniques", T.ArrayType(T.StringType())),
    T.StructField("tools_databases", T.ArrayType(T.StringType())),
])


def corpus_prompt(chunks: DataFrame, kind: str = "themes", corpus_col: str = "corpus") -> Column:
    """The prompt of ``kind`` around each corpus chunk."""
    head, tail = PROMPTS[kind].split("{corpus_text}")
    return F.concat(F.lit(head), F.coalesce(F.col(corpus_col), F.lit("")), F.lit(tail))


def parse_themes(df: DataFrame, raw_col: str, keys: list[str]) -> DataFrame:
    """One row per theme ``(keys..., theme_index, theme, description, key_concepts, main_message)``.

    A reply that is not valid JSON of this layout yields no theme rows.
    """
    p = df.select(*keys, F.from_json(F.col(raw_col), THEMES_SCHEMA).alias("_r"))
    return p.select(
        *keys, F.posexplode(F.coalesce(F.col("_r.thematic_axes"), F.array())).alias("theme_index", "_t"),
        F.col("_r.main_message").alias("main_message"),
    ).select(
        *keys, "theme_index", F.col("_t.theme").alias("theme"), F.col("_t.description").alias("description"),
        F.col("_t.key_concepts").alias("key_concepts"), "main_message",
    )


def parse_methodology(df: DataFrame, raw_col: str, keys: list[str]) -> DataFrame:
    """One row per reply with the two text fields and the two lists."""
    p = df.select(*keys, F.from_json(F.col(raw_col), METHODOLOGY_SCHEMA).alias("_r"))
    return p.select(*keys, "_r.*")
