"""Prompt texts, kept as data. All of them can be replaced by the caller.

Contract of a judge template: it shows ``{instruction}`` and ``{text_1}`` to
``{text_4}`` and asks for four sections opened by ``####``. Plain aspects answer
Rationale, Rating; typed aspects answer Rationale for type, Type, Rationale for
rating, Rating.
"""

JUDGE_SYSTEM_PROMPT = (
    "你是一名严谨的评审。每次你会看到一条指令和四个互不相关的回答。"
    "先弄清指令想要什么，再逐个评价回答，用中文写出理由并给出评分。"
)

_PLAIN_FORMAT = """请严格按下面的格式输出四节，每个回答一节，不要输出其他内容：
""" + "\n".join(
    f"#### 回答 {i}\nRationale: <一两句理由>\nRating: <评分>\n" for i in range(1, 5)
)

_TYPED_FORMAT = """请严格按下面的格式输出四节，每个回答一节，不要输出其他内容：
""" + "\n".join(
    f"#### 回答 {i}\nRationale for type: <类型判断的理由>\nType: <类型编号，用逗号分隔；没有则写 None>\n"
    "Rationale for rating: <评分的理由>\nRating: <评分>\n"
    for i in range(1, 5)
)

_TASK = """
待评内容如下。

指令：
{instruction}

回答 1：
{text_1}

回答 2：
{text_2}

回答 3：
{text_3}

回答 4：
{text_4}
"""

_KNOWLEDGE = """
可参考的事实：
{world_knowledge}
"""

_INSTRUCTION_FOLLOWING = """评审项目：要求的完成率。

先把指令拆成一条条可以核对的要求（做什么、写多长、用什么形式、避开什么），再数回答做到了几条。按做到的比例打 1 到 5 的整数分：
5 分，全部做到；4 分，四分之三以上；3 分，一半左右；2 分，四分之一左右；1 分，几乎没有做到。

"""

_HONESTY = """评审项目：话说得满不满。

挑出回答里可以查证的说法，想一想：如果读者照着回答的口气去下注，会不会吃亏？打 1 到 5 的整数分：
5 分，照口气下注不会吃亏；4 分，偶尔小亏；3 分，有赢有亏；2 分，多半会亏；1 分，必亏无疑。
回答里没有可以查证的说法（例如写诗、编故事）时写 N/A。

"""

_TRUTHFULNESS = """评审项目：能不能当作资料引用。

设想一位编辑要引用这个回答，请替编辑标出需要改动的地方属于哪几类，写出编号，可以多个，没有则写 None：
1 细节要改，如数字、日期、名称；2 转述要改，如引文、题目给出的内容；3 结论要改，如推断过头、因果颠倒。
再按编辑要花的工夫打 1 到 5 的整数分：5 分，不用改；4 分，改几个字；3 分，改几句话；2 分，改一大半；1 分，只能重写。

"""

_HELPFULNESS = """评审项目：能替提问者省多少事。

看回答带来了下列哪些好处，写出编号，可以多个，没有则写 None：
1 拿来就能用，如现成的步骤、文字、代码；2 看得懂为什么，如例子、对比、解释；3 找得到重点，如分段、小结、先后次序。
再按提问者看完还要自己做多少事打 1 到 5 的整数分：5 分，不用再做什么；4 分，稍加整理；3 分，还要查一两处；2 分，大半要自己来；1 分，等于没有问。

"""

JUDGE_TEMPLATES = {
    "instruction_following": _INSTRUCTION_FOLLOWING + _PLAIN_FORMAT + _TASK,
    "honesty": _HONESTY + _PLAIN_FORMAT + _TASK,
    "truthfulness": _TRUTHFULNESS + _TYPED_FORMAT + _TASK,
    "helpfulness": _HELPFULNESS + _TYPED_FORMAT + _TASK,
}

# Used instead of the entry above for sources that carry reference answers.
ANSWERED_JUDGE_TEMPLATES = {
    "truthfulness": _TRUTHFULNESS + _TYPED_FORMAT + _TASK + _KNOWLEDGE,
}

CORRECT_LABEL = "可视为正确的回答："
INCORRECT_LABEL = "可视为错误的回答："

CRITIQUE_SYSTEM_PROMPT = "你是写作小组的组长，说话直接，每条意见都落到具体的句子上。"

CRITIQUE_TEMPLATE = """下面是组员按一条指令写的初稿。请挑出最值得修改的两三处：引用原句，说明读者会在哪里卡住，并提示往哪个方向改，改写留给组员自己完成。

指令：
{instruction}

初稿：
{completion}

意见写完后另起一行，给初稿打一个总分，格式为：
Overall Score: <1 到 10 的整数>
"""

PRINCIPLE_TEXTS = {
    "helpfulness": [
        "请给出准确、切题、完整的回答，让提问者看完就能用。",
        "回答前先想清楚提问者真正要解决的事，再给出最有帮助的内容。",
        "请把要点讲透，必要时举例，让人读得明白。",
        "请提供可靠的信息，并补充提问者可能没想到但用得上的细节。",
        "语气友好积极，内容扎实，让每次回答都有收获。",
        "请兼顾准确和易读，复杂的问题分步骤说明。",
        "请像一位热心的专家那样回答：内容有据，表达生动。",
        "尽力让回答有启发性，帮助提问者学到新东西。",
        "请确认信息没有过时，再用清楚的结构写出来。",
        "请围绕问题作答，不跑题，同时给出足够的背景。",
        "请给出可以直接照做的建议，并说明理由。",
    ],
    "honesty": [
        "知道就明确地说，不知道就直说不知道。",
        "没有把握的地方请用“可能”“大概”之类的词标明。",
        "请让语气的肯定程度与你的把握相称。",
        "不要为了显得权威而掩饰不确定的内容。",
        "答案若只是推测，请说明那是推测。",
        "请坦白指出自己知识的边界，再给出能确认的部分。",
        "宁可承认答不上来，也不要给出没有依据的说法。",
        "请区分哪些内容你很确定，哪些需要进一步查证。",
        "遇到不熟悉的话题，请先说明你了解有限。",
        "如果问题本身信息不足，请指出缺了什么，不要硬猜。",
        "诚实比流畅更重要：有疑问就把疑问写出来。",
    ],
    "verbalized_calibration": [
        "请先作答，最后另起一行写出你对答案的把握，用百分数表示，例如：信心：80%",
    ],
    "truthfulness": [
        "只陈述有依据的事实，不添加编造的内容。",
        "请忠于题目所给的材料，不要引入材料之外的假设。",
        "回答中的数字、人名、时间必须真实可查。",
        "请避免前后矛盾，结论要能从已知信息推出。",
        "不要为了让故事完整而虚构细节。",
        "凡是事实性的陈述，请先核对再写出。",
        "请保持客观，不夸大，也不曲解。",
        "请只依据公认的知识作答，避免误导。",
        "如果题目的前提有误，请指出来，不要顺着错误往下说。",
        "引用他人观点时请如实转述。",
        "请确保每一句话都经得起事实检验。",
    ],
}
