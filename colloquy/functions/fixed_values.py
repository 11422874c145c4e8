"""Texts, prices, limits and patterns that results depend on.

Nothing here is logic. These values are part of the data contract: a prompt, a refusal
message or a price has to be exactly this for results to match.
"""

# ---- fixed values: cleaning -------------------------------------------------------------
MIN_RESPONSE_CHARS = 20
MIN_INSTRUCTION_CHARS = 5
QUALITY_FLAGS = "BIK"

# Unicode white space plus the four ASCII separators, as one character class body.
WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The characters that end a line.
LINE_BREAK_CLASS = r"\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}"

# ---- fixed values: prompts --------------------------------------------------------------
SYSTEM_PROMPT = (
    "You are a helpful, professional customer support agent. "
    "Respond clearly and empathetically to customer inquiries. "
    "Be concise, accurate, and solution-focused."
)

AGENT_SYSTEM_PROMPT = """You are a helpful, professional customer support agent with access to real-time tools.

When a customer asks about a specific order, account, or requests an action (refund, cancellation, return, etc.),
use the appropriate tool to get accurate information before responding.

For general questions (shipping policies, return windows, etc.), answer directly.

Available tools: {tool_list}

To call a tool, respond with:
TOOL_CALL: <tool_name>({"param": "value", ...})

After getting the tool result, respond naturally to the customer."""

TOOL_RESULT_TURN = (
    "Tool result:\n{tool_result}\n\nPlease respond to the customer based on this information."
)

RATING_PROMPT = """You are evaluating AI customer support responses. Score the response on three criteria, each from 1-5.

Customer question: {instruction}

Response to evaluate:
{response}

Rate the response on:
1. HELPFULNESS (1-5): Does it address and resolve the customer's actual problem?
   1=completely unhelpful, 5=fully resolves the issue
2. ACCURACY (1-5): Is the information correct, specific, and actionable?
   1=wrong/vague, 5=accurate and specific
3. PROFESSIONALISM (1-5): Is the tone appropriate for customer support?
   1=rude/robotic, 5=empathetic and professional

Return ONLY valid JSON in this exact format:
{"helpfulness": X, "accuracy": X, "professionalism": X, "reasoning": "brief explanation"}"""

PREFERENCE_PROMPT = """You are comparing two customer support responses. Pick the better one.

Customer question: {instruction}

Response A:
{response_a}

Response B:
{response_b}

Which response better resolves the customer's issue? Consider helpfulness, accuracy, and professionalism.
Return ONLY valid JSON: {"winner": "A" or "B", "reasoning": "brief explanation"}"""

# ---- fixed values: text metrics ---------------------------------------------------------
ROUGE_TOKEN = "[a-z0-9]+"

# The mteval 13a tokenisation rules as (pattern, replacement), in order of application.
BLEU_13A_RULES = [
    (r"<skipped>", ""),
    (r"-\n", ""),
    (r"\n", " "),
    (r"&quot;", '"'),
    (r"&amp;", "&"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"^|$", " "),
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]

# The label of an example that is picked to be shown.
EXAMPLE_LABEL = "**Intent:** `{intent}`  ·  **Category:** `{category}`"

# Metrics shown in a comparison, in order, with the ones where a lower value is better.
COMPARED_METRICS = ["bleu", "rouge1", "rouge2", "rougeL", "avg_pred_length", "avg_latency_ms"]
LOWER_IS_BETTER = ["avg_pred_length", "avg_latency_ms", "p95_latency_ms"]
JUDGE_METRICS = ["avg_helpfulness", "avg_accuracy", "avg_professionalism", "avg_composite"]

# ---- fixed values: judge error messages -------------------------------------------------
RETRY_AFTER = r"try again in\s+(?:(\d+)h\s*)?(?:(\d+)m\s*)?(\d+(?:\.\d+)?s)?"
RETRY_BUFFER_SECONDS = 5
RATE_LIMIT_MARKS = ["429", "rate_limit"]
DAILY_LIMIT_MARKS = ["tokens per day", "TPD"]

# ---- fixed values: support tools --------------------------------------------------------
# tool name -> (required arguments, optional arguments)
TOOL_CATALOGUE = {
    "lookup_order": (["order_id"], []),
    "update_shipping_address": (["order_id", "new_address"], []),
    "cancel_order": (["order_id"], ["reason"]),
    "get_return_label": (["order_id", "item_name", "return_reason"], []),
    "get_account_info": (["customer_email"], []),
    "unlock_account": (["customer_email"], []),
    "update_subscription": (["customer_email", "new_plan"], []),
    "cancel_subscription": (["customer_email"], ["reason"]),
    "process_refund": (["customer_email", "order_id", "amount", "reason"], []),
}
TOOL_CALL_MARK = "TOOL_CALL:"
ORDER_ID_PREFIX = "ORD-"
SHIPPED_STATUSES = ["shipped", "out_for_delivery", "delivered"]
RETURN_WINDOW_DAYS = 30
REFUND_LIMIT = 500
PLAN_PRICES = {"Basic": "9.99", "Standard": "19.99", "Premium": "39.99"}
RETURN_LABEL_URL = "https://returns.example.com/label/"

MESSAGES = {
    "invalid_order_id": "Invalid order ID format: {0}. Expected format: ORD-XXXXXX",
    "address_already_shipped": (
        "Cannot update address — order is already {0}. "
        "Contact the carrier directly to redirect the package."
    ),
    "address_ok": "Shipping address updated successfully.",
    "cancel_already_shipped": (
        "Cannot cancel — order is already {0}. "
        "Please use our return process once the package arrives."
    ),
    "already_cancelled": "Order is already cancelled.",
    "not_delivered": "Returns are only available for delivered orders. Current status: {0}.",
    "window_expired": (
        "Return window has expired. Items must be returned within 30 days of delivery "
        "(delivered {0} days ago)."
    ),
    "invalid_email": "Invalid email address: {0}",
    "unlock_cancelled": "Cannot unlock a cancelled account. Please create a new account.",
    "unlock_ok": (
        "Your account has been unlocked. "
        "A password reset link has been sent to your email. "
        "The link expires in 1 hour."
    ),
    "invalid_plan": "Invalid plan: {0}. Available plans: ['Basic', 'Standard', 'Premium']",
    "plan_blocked": "Cannot change plan — account is {0}.",
    "same_plan": "Account is already on the {0} plan.",
    "plan_upgraded": "Upgraded from {0} to {1}. New features are available now.",
    "plan_downgraded": "Downgraded from {0} to {1}. Current plan active until next billing date.",
    "subscription_already_cancelled": "Subscription is already cancelled.",
    "subscription_cancelled": (
        "Subscription cancelled. You'll retain access until {0}. No further charges will be made."
    ),
    "refund_not_positive": "Refund amount must be greater than zero.",
    "refund_escalated": (
        "Refund of ${0} exceeds the automated limit ($500). "
        "A senior agent will review and process this within 24 hours."
    ),
    "refund_ok": "Refund of ${0} initiated to your {1}.",
}
ORDER_REFUND_METHOD = "original payment method"
REFUND_ETA = "3-5 business days"
RETURN_REFUND_ETA = "5-7 business days after receipt"
RETURN_CARRIER = "USPS"
UNLOCK_ACTION = "account_unlocked + password_reset_sent"
EFFECTIVE_UPGRADE = "immediately"
EFFECTIVE_DOWNGRADE = "next billing cycle"
REACTIVATION_INFO = "You can reactivate your subscription at any time."
RETURN_INSTRUCTIONS = (
    "1. Pack the item securely in original packaging if possible.\n"
    "2. Print and attach the return label.\n"
    "3. Drop off at any authorized carrier location.\n"
    "4. Refund processed within 5-7 days of receiving your return."
)
