"""They must equal those of the format that datasets of this kind are exchanged in."""

# Enumerations of the dataset row.
TASK_TYPES = ("qa", "mcq", "problem_solving", "instruction_following", "code", "dpo")
MODALITIES = ("text", "image", "audio")
LANGUAGES = ("mn", "en")
DIFFICULTIES = ("beginner", "intermediate", "advanced")

# Columns of the dataset row, in order.
ROW_COLUMNS = ("id", "source", "category", "type", "instruction", "input", "choices", "answer", "thinking", "difficulty", "language", "modality", "media_path", "pair_id")
ROW_DDL = ", ".join(f"{c} {'array<string>' if c == 'choices' else 'string'}" for c in ROW_COLUMNS)

# File extensions by modality.
EXTENSIONS = {
    "text": (".txt", ".md", ".jsonl", ".json"),
    "image": (".jpg", ".jpeg", ".png", ".webp", ".bmp"),
    "audio": (".wav", ".mp3", ".flac", ".m4a", ".ogg", ".opus"),
}

# Names of languages and what a task of each type asks for.
LANGUAGE_NAMES = {"mn": "Mongolian", "en": "English"}
TASK_GUIDANCE = {
    "qa": "a direct factual question with a concise correct answer",
    "mcq": "a multiple-choice question with 4 options in `choices`, exactly one of which is copied verbatim into `answer`",
    "problem_solving": "a problem (math, logic, or reasoning) that requires working through steps to reach `answer`",
    "instruction_following": "an instruction/task with no single fixed answer format, where `answer` is the ideal response to the instruction",
    "code": "a programming task; `instruction` describes the task, `answer` is working code (comments in the requested language, code keywords stay in the programming language itself)",
    "dpo": "an instruction plus a genuinely correct/preferred `answer` (paired later against a worse response elsewhere in the pipeline; here you only need to produce the good one)",
}

# Prompt templates. {chunk}, {lang}, {type}, {guidance}, {difficulty} are filled in.
TEXT_PROMPT = """Source passage (may be in Mongolian or English, use it only as
grounding material, do not just copy sentences from it verbatim):

---
{chunk}
---

Using this passage as inspiration/grounding, write ONE {lang}-language
training item of type "{type}": {guidance}.
Target difficulty: {difficulty}.
Pick a specific `category` (subject area, e.g. "history", "physics",
"programming", "geography", "everyday_conversation" -- be specific, not just
"general").
Respond with a single JSON object only, in {lang}, matching the required
schema."""
IMAGE_PROMPT = """Look at the attached image. Using it as grounding, write ONE
{lang}-language training item of type "{type}": {guidance}.
The item must be answerable ONLY by someone who can see the image (or the
transcribed description you provide) -- do not write a generic question
that ignores the image.
Target difficulty: {difficulty}. Pick a specific `category` (e.g.
"visual_qa", "chart_reading", "document_ocr", "scene_description").
Respond with a single JSON object only, in {lang}, matching the required
schema."""
AUDIO_PROMPT = """Transcript of a short audio clip (may contain transcription
errors -- treat words you're unsure of with suspicion rather than as fact):

---
{chunk}
---

Using this transcript as grounding, write ONE {lang}-language training item
of type "{type}": {guidance}.
Target difficulty: {difficulty}. Pick a specific `category` (e.g.
"speech_comprehension", "spoken_qa", "summarization").
Respond with a single JSON object only, in {lang}, matching the required
schema."""

# Default settings.
MIN_CHARS, MAX_CHARS = 600, 4000
TASK_WEIGHTS = {"qa": 30, "mcq": 20, "problem_solving": 15, "instruction_following": 15, "code": 10, "dpo": 10}
LEASE_SECONDS, LEASE_ITEMS, MOST_FAILURES = 1200, 4, 4
ROWS_PER_SHARD = 5000
TEST_ROWS, VALIDATION_ROWS = 800, 300
