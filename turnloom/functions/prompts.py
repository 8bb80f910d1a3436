"""Prompt templates: string concatenation over instruction, input and output columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Template pieces and system prompts.
DEFAULT_SYSTEM = "You are a helpful assistant."
CHAT_SYSTEM = "你是一个智能助手。请全程使用中文回答用户的问题，保持专业和友善。"
QA_SYSTEM = """你是一个专业的中文AI助手。你只能用中文回答问题。注意以下要求：
1. 保持逻辑清晰，语言连贯，避免前言不搭后语
2. 如果提供了知识库内容，必须基于知识库内容作答
3. 不要编造内容，如果不确定就说"抱歉，我对这方面不太确定"
4. 每个回答都应该有清晰的重点和结构
5. 如果遇到复杂问题，需要分点解释"""
KNOWLEDGE_SYSTEM = """你是一个专业的中文AI助手。请严格遵守以下原则：

1. 语言要求：
   - 必须全程使用规范的中文
   - 避免使用任何英文句子
   - 不使用表情符号
   - 专业术语需要加中文说明，如：LLaMA（大语言模型）

2. 回答规范：
   - 保持清晰的逻辑结构
   - 语言要简洁准确
   - 重点突出，条理分明
   - 如果不确定，明确说"不确定"

3. 知识库使用：
   - 严格基于提供的知识库内容
   - 不要随意添加未提供的信息
   - 如果知识库信息不足，说明需要补充

4. 回答格式：
   - 开门见山，直接回答问题
   - 必要时使用分点说明
   - 适当使用标点符号组织语言
   - 保持段落清晰

5. 严格禁止：
   - 不能使用英文对话
   - 不能使用表情符号
   - 不能插入题外话
   - 不能做无根据的推测"""
PLAIN_SYSTEM = """你是一个专业的中文AI助手。请严格遵守以下原则：

1. 语言要求：
   - 必须全程使用规范的中文
   - 避免使用任何英文句子
   - 不使用表情符号
   - 专业术语需要加中文说明

2. 回答规范：
   - 保持清晰的逻辑结构
   - 语言要简洁准确
   - 重点突出，条理分明
   - 如果不确定，明确说"不确定"

3. 回答格式：
   - 开门见山，直接回答问题
   - 必要时使用分点说明
   - 适当使用标点符号组织语言
   - 保持段落清晰"""
EXPERT_SYSTEM = """你是一位专业的AI技术专家，尤其专注于Llama和LoRA等大模型技术领域。请严格遵守以下原则：

1. 专业性要求：
   - 必须准确区分LoRA(低秩适配技术)和LoRa(无线技术)
   - 准确理解和使用AI技术概念
   - 回答必须体现深入的专业知识
   - 涉及Llama、LoRA等技术时必须准确描述其原理

2. 语言要求：
   - 必须全程使用规范的中文回答
   - 所有专业术语都要加中文解释
   - 严格禁止使用英文句子
   - 使用中文数字和标点符号

3. 知识范围：
   - 专注于AI模型训练和优化技术
   - 重点是Llama系列模型的特点和应用
   - 详细说明LoRA等参数高效微调方法
   - 准确描述模型训练和评估方法

4. 表达规范：
   - 结构要层次分明
   - 解释要深入浅出
   - 适当举例说明
   - 突出技术重点"""
EXPERT_LEAD = "请用中文回答以下问题：\n"
CONTEXT_INTRO_REFERENCE = "根据以下参考资料回答：\n\n"
CONTEXT_INTRO_KNOWLEDGE = "基于以下知识库内容：\n\n"
EXTRA_INTRO = "\n\n补充信息："
SECTION_TITLES = ("### 指令：", "\n### 输入：", "\n### 响应：")
DOCUMENT_LABEL = "文档："


def _block(role: str, body: Column) -> Column:
    return F.concat(F.lit(f"<|start_header_id|>{role}<|end_header_id|>\n\n"), body, F.lit("<|eot_id|>"))


def _optional(body: Column, before: str, after: str = "") -> Column:
    """``before + body + after`` when the body is there, else nothing."""
    present = F.coalesce(F.length(body) > 0, F.lit(False))
    return F.when(present, F.concat(F.lit(before), body, F.lit(after))).otherwise("")


def user_message(instruction: Column, extra: Column) -> Column:
    return F.concat(instruction, _optional(extra, "\n"))


def header_system(instruction: Column, extra: Column, output: Column, system: str = DEFAULT_SYSTEM) -> Column:
    return F.concat(
        _block("system", F.lit(system)),
        _block("user", user_message(instruction, extra)),
        _block("assistant", output),
    )


def header_plain(instruction: Column, extra: Column, output: Column) -> Column:
    return F.concat(
        _block("user", user_message(instruction, extra)), _block("assistant", output), F.lit("\n")
    )


def header_open(instruction: Column, extra: Column, system: str = DEFAULT_SYSTEM) -> Column:
    """Left open where the assistant is to speak."""
    return F.concat(
        _block("system", F.lit(system)),
        _block("user", user_message(instruction, extra)),
        F.lit("<|start_header_id|>assistant<|end_header_id|>\n\n"),
    )


def inst(instruction: Column, extra: Column) -> Column:
    return F.concat(F.lit("[INST] "), user_message(instruction, extra), F.lit(" [/INST]"))


def inst_sys(
    instruction: Column, context: Column, extra: Column, system: str = QA_SYSTEM, lead: str = ""
) -> Column:
    """System prompt in its own tags, reference material if any, ``lead`` and question, extra information if any."""
    return F.concat(
        F.lit(f"[INST] <<SYS>>\n{system}\n<</SYS>>\n\n"),
        _optional(context, CONTEXT_INTRO_REFERENCE, "\n\n"),
        F.lit(lead),
        instruction,
        _optional(extra, EXTRA_INTRO),
        F.lit(" [/INST]"),
    )


def inst_context(instruction: Column, context: Column | None = None, system: str = KNOWLEDGE_SYSTEM) -> Column:
    """System prompt, knowledge block if any, question; without a context the system-only form."""
    return F.concat(
        F.lit(f"[INST] {system}\n\n"),
        F.lit("") if context is None else _optional(context, CONTEXT_INTRO_KNOWLEDGE, "\n\n"),
        instruction,
        F.lit(" [/INST]"),
    )


def sections(instruction: Column, extra: Column, output: Column) -> Column:
    a, b, c = SECTION_TITLES
    return F.concat(F.lit(a), instruction, F.lit(b), extra, F.lit(c), output)


def training_text(prompt: Column, target: Column) -> Column:
    return F.concat(prompt, F.lit(" "), target)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(instruction: Column, extra: Column, output: Column, system: str = CHAT_SYSTEM) -> Column:
    return F.array(
        message("system", F.lit(system)),
        message("user", user_message(instruction, extra)),
        message("assistant", output),
    )


def history_messages(history: Column, new_message: Column) -> Column:
    """``array<struct<user, bot>>`` and the next user message as one message array."""
    past = F.transform(history, lambda h: F.array(message("user", h["user"]), message("assistant", h["bot"])))
    return F.concat(F.flatten(past), F.array(message("user", new_message)))
